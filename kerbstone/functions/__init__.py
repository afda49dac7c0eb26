"""Column builders. All are built-in Spark expressions: no UDFs, no Python workers.

Rules that apply to dozens of columns are written as one SQL text per column. That
makes one call into the JVM each, where composed Column objects make ten or more, and
a streaming job builds its plan anew for every micro-batch.
"""
