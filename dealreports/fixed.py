"""Names, lists and literals that must be spelled as the source records spell them.

Double spaces and the stray bracket in the last label belong to the data.
"""

from datetime import datetime
from decimal import Decimal

# Labels of a transaction row and of an agent row, in report order.
ALL_LABELS = """
Contract Title
Contract Client Type
Empower TC Name
Empower Agent Name
Contract Status
CTC Started with Empower
Closing
CTC PAID Date
Listing Started with Empower
Live on MLS Date
Listing PAID Date
Offer Started with Empower
Offer Prep PAID Date
Compliance Started with Empower
Compliance Est  Completion Date
Compliance PAID Date
Listing Standard - 150
Listing Premium - 200
Listing Elite - 250
Listing Monthly
CTC Standard - 350
CTC Listing Discount - 300
CTC Dual Discount - 300
CTC Cash or New Build
CTC Monthly
CTC Terminated in Option - 50
CTC Terminated 50 Percent Complete
CTC Terminated 75 Percent Complete
Offer Prep - 40
Compliance Lite - 50
Compliance Only -  100
Compliance Plus -  150
Buyer Rep to be Paid w CTC
Social Add-on Paid w Listing
Billing Notes
Utility Concierge
Homeowners Insurance
Sellers Shield
Home Warranty
1st Listing with Empower
1st CTC with Empower
Utility Concierge Taken
Home Insurance Taken
Home Warranty Taken
Listing PAID Amount
CTC PAID Amount
Offer Prep PAID Amount
Compliance PAID Amount
Initial Offer Prep - 100
CC Decline Date
CTC Withdrawn Date
Contract Terminated
1st Compliance with Empower
CTC Terminated Paid Date
CTC Terminated Paid Amount
Promo Notes
CTC Term - No Charge
CTC Term - Compliance 50
Transaction PAID via
Billing Status
Home Warranty Company
Other Home Warr Co
Partner HW Ordered
Partner HW Invoice Received
Partner HW Complete - Admin 1
Home Warranty Status
Property Type
Home Warranty Paid by
Transaction State
UC Email Sent Date
UC Email Sent By
Listing Standard - 200
Listing Elite - 300
CTC Standard - 400
CTC Standard - 450
CTC Listing Discount - 350
CTC Listing Discount - 400
CTC Dual Discount - 350
CTC Dual Discount - 400
CTC Standard - 300
Free of Charge
Other Amount
Listing White Label
Offer White Label
CTC White Label
Compliance White Label
Billing Amount
TC Commission Rate
TC Commission Amount
Listing done by Empower
Preferred  Ai  CTC
Time Zone
Team
Team User
Created By
Date Created
Empower Account Exec
Empower CXM
Transaction Coordinator
Onboard Call Complete Date
Onboarding Status
1st Transaction Date
CC - Terms of Use Status
CC - Terms of Use Date
Avg Closings Yr
Avg Listings Yr
Brokerage
Broker City
Agent Email
Agent Phone Number
Utility Concierge Opt In - do not use
Home Insurance Opt In
Agent Provided by
Other Status
Reassigned From
Reassigned Date
Referred to Empower by
Commission Tier
MSA - if applies
Admin Early Tier 2 Date
Monthly Billing - if applies
Agent State
Empower HW Partners
Utility Setup Opt in
Agent Experience Level
Meet   Greet Call Complete
Transaction Coordinator 2
Agent State 2
Roster OB Complete Date
Home Warranty Amount
Date Created]
""".strip("\n").split("\n")

# The ordered columns of a curated transaction.
ORDER_COLUMNS = """
Contract Title
Contract Client Type
Empower TC Name
Empower Agent Name
Contract Status
CTC Started with Empower
Closing
CTC PAID Date
Listing Started with Empower
Live on MLS Date
Listing PAID Date
Offer Started with Empower
Offer Prep PAID Date
Compliance Started with Empower
Compliance Est  Completion Date
Compliance PAID Date
Listing Standard - 150
Listing Premium - 200
Listing Elite - 250
Listing Monthly
CTC Standard - 350
CTC Listing Discount - 300
CTC Dual Discount - 300
CTC Cash or New Build
CTC Monthly
CTC Terminated in Option - 50
CTC Terminated 50 Percent Complete
CTC Terminated 75 Percent Complete
Offer Prep - 40
Compliance Lite - 50
Compliance Only -  100
Compliance Plus -  150
Buyer Rep to be Paid w CTC
Social Add-on Paid w Listing
Billing Notes
Utility Concierge
Homeowners Insurance
Sellers Shield
Home Warranty
1st Listing with Empower
1st CTC with Empower
Utility Concierge Taken
Home Insurance Taken
Home Warranty Taken
Listing PAID Amount
CTC PAID Amount
Offer Prep PAID Amount
Compliance PAID Amount
Initial Offer Prep - 100
CC Decline Date
CTC Withdrawn Date
Contract Terminated
1st Compliance with Empower
CTC Terminated Paid Date
CTC Terminated Paid Amount
Promo Notes
CTC Term - No Charge
CTC Term - Compliance 50
Transaction PAID via
Billing Status
Home Warranty Company
Other Home Warr Co
Partner HW Ordered
Partner HW Invoice Received
Partner HW Complete - Admin 1
Home Warranty Status
Property Type
Home Warranty Paid by
Transaction State
UC Email Sent Date
UC Email Sent By
Listing Standard - 200
Listing Elite - 300
CTC Standard - 400
CTC Standard - 450
CTC Listing Discount - 350
CTC Listing Discount - 400
CTC Dual Discount - 350
CTC Dual Discount - 400
CTC Standard - 300
Free of Charge
Other Amount
Listing White Label
Offer White Label
CTC White Label
Compliance White Label
Billing Amount
TC Commission Rate
TC Commission Amount
Listing done by Empower
Preferred  Ai  CTC
Time Zone
Team
Team User
Created By
Date Created
1st Transaction Date
Reassigned Date
Brokerage
Agent Provided by
""".strip("\n").split("\n")

# Curated columns that hold dates.
DATE_COLUMNS = """
Closing
CTC Started with Empower
CTC PAID Date
Listing Started with Empower
Live on MLS Date
Listing PAID Date
Offer Started with Empower
Offer Prep PAID Date
Compliance Started with Empower
Compliance Est  Completion Date
Compliance PAID Date
CC Decline Date
CTC Withdrawn Date
Contract Terminated
CTC Terminated Paid Date
Partner HW Ordered
Partner HW Invoice Received
1st Transaction Date
Reassigned Date
UC Email Sent Date
""".strip("\n").split("\n")

# Curated columns whose blanks become 0.
ZERO_FILL_COLUMNS = """
Listing Standard - 150
Listing Premium - 200
Listing Elite - 250
Listing Monthly
CTC Standard - 350
CTC Listing Discount - 300
CTC Dual Discount - 300
CTC Cash or New Build
CTC Monthly
CTC Terminated in Option - 50
CTC Terminated 50 Percent Complete
CTC Terminated 75 Percent Complete
Offer Prep - 40
Compliance Lite - 50
Compliance Only -  100
Compliance Plus -  150
Buyer Rep to be Paid w CTC
Social Add-on Paid w Listing
Billing Notes
Utility Concierge
Homeowners Insurance
Sellers Shield
Home Warranty
1st Listing with Empower
1st CTC with Empower
Utility Concierge Taken
Home Insurance Taken
Home Warranty Taken
Listing PAID Amount
CTC PAID Amount
Offer Prep PAID Amount
Compliance PAID Amount
Initial Offer Prep - 100
CTC Term - No Charge
CTC Term - Compliance 50
""".strip("\n").split("\n")

# Curated columns whose blanks become none.
NONE_FILL_COLUMNS = """
CC Decline Date
CTC Withdrawn Date
Contract Terminated
1st Compliance with Empower
CTC Terminated Paid Date
CTC Terminated Paid Amount
Promo Notes
Transaction PAID via
Billing Status
Home Warranty Company
Other Home Warr Co
Partner HW Complete - Admin 1
Home Warranty Status
Property Type
Home Warranty Paid by
""".strip("\n").split("\n")

# Report names of five columns that every record has outside its attribute list.
SYSTEM_COLUMNS = {
    "timezone": "Time Zone",
    "team_name": "Team",
    "team_user_name": "Team User",
    "created": "Date Created",
    "agent_name": "Created By",
}

# The agent-account fields that a transaction receives by the join.
AGENT_FIELDS = ["1st Transaction Date", "Reassigned Date", "Brokerage", "Agent Provided by"]

# Attribute keys read by the monthly counts and the extracts.
ATTRIBUTE_KEYS = [
    "contract_status",
    "closing_date",
    "contract_client_type",
    "ctc_started_with_empower",
    "listing_started_with_empower",
    "listing_paid_date",
    "compliance_started_with_empower",
    "compliance_paid_date",
]

# Team lists of the extracts.
CTC_TEAMS = [
    "Team Christianna Velazquez",
    "Team Kimberly Lewis",
    "Team Stephanie Kleinman",
    "Team Molly Kelley",
    "Jenn McKinley",
    "Team Jenn McKinley",
]
PREFERRED_TEAMS = [
    "Team Molly Kelley",
    "Preferred CTC Team",
    "Team Marrisa Anderson",
    "Team EpiqueTC",
    "Team EpiqueTC AA",
    "Team EpiqueEST",
    "Team EpiqueEST AA",
    "Team EpiqueCST",
    "Team EpiqueCST AA",
    "Team EpiqueCA",
    "Team EpiqueCA AA",
]

# Coordinators on the payroll.
PAYROLL_COORDINATORS = [
    "Christianna Velazquez",
    "Kimberly Lewis",
    "Stephanie Kleinman",
    "Molly Kelley",
    "Jenn McKinley",
]

# Statuses.
AGENT_ACCOUNT = "AGENT ACCOUNT"
CTC_PENDING = "CTC - Pending"
CTC_CLOSED_PAID = "CTC - Closed - PAID"
PREFERRED_PENDING = "CTC - Preferred - Pending"
PREFERRED_READY = "CTC - Preferred - Closed - Ready to BILL"

# Statuses whose closing date is emptied during curation.
NO_CLOSING_STATUSES = [
    "Compliance - PAID",
    "Compliance - Ready to BILL",
    "CTC - Preferred - Terminated - No Change",
    "CTC - Terminated - No Change",
    "CTC - Preferred - Withdrawn",
    "CTC - Withdrawn",
    "Listing - PAID",
    "Listing - Pre-Listing",
]

# Status sets of the daily update.
DAILY_CTC_STATUSES = [
    "CTC - Closed - PAID",
    "CTC - Pending",
    "CTC - PAID",
    "CTC - Terminated - No Charge",
    "CTC - Withdrawn",
    "CTC - Terminated - Compliance - PAID",
]
DAILY_PREFERRED_STATUSES = [
    "CTC - Preferred - Closed - PAID",
    "CTC - Preferred - Pending",
    "CTC - Preferred - PAID",
    "CTC - Preferred - Terminated - No Change",
    "CTC - Preferred - Withdrawn",
]
LOST_AGENT_STATUSES = [
    "Lost  Reassigned",
    "Lost  Left Empower",
    "Return to Sales",
    "Lost - Do Not Contact",
    "Lost  Do Not Contact",
    "Lost - Left Empower",
    "Lost - Reassigned",
]

# Words that mark a title as no real deal.
EXCLUDED_TITLE_WORDS = ["test", "training", "delete"]

# Dates standing for an empty date, the commission rate, the default amounts and the year rule.
STAGING_DATE_FILLER = datetime(1899, 12, 30)
REPORT_DATE_FILLER = datetime(1990, 1, 1)
COMMISSION_RATE = Decimal("0.5")
PREFERRED_BILLING_AMOUNT = "99"
STANDARD_BILLING_AMOUNT = "400"
CUTOVER_YEAR = 2021

# The two lists below are not given anywhere but follow from those above; staging takes others as ``Lists``.
# A transaction has the ordered columns less those that come from the system or the agent account.
TRANSACTION_LABELS = [
    c for c in ORDER_COLUMNS if c not in SYSTEM_COLUMNS.values() and c not in AGENT_FIELDS
]
# An agent account has its title and status and every label a transaction does not have.
AGENT_LABELS = ["Contract Title", "Contract Status"] + [
    c
    for c in ALL_LABELS
    if c not in TRANSACTION_LABELS and c not in SYSTEM_COLUMNS.values() and c != ALL_LABELS[-1]
]
