"""SQL expressions as text.

Each function takes column names or expressions as text and gives expression text, for
`selectExpr`, `filter` or `F.expr`. Text composes freely and reaches the JVM in one call, where a
chain of Column calls would need dozens. Everything stays inside generated code; there is no UDF.
"""
