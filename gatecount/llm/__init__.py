"""Operations for preparing large language-model training corpora on Spark.

Nothing else in the package imports this subpackage; it can be removed without
touching the attendance engine.
"""
