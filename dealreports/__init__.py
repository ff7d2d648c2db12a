"""Spark DataFrame reports over deal records whose attributes arrive as JSON lists."""
