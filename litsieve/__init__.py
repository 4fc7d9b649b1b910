"""litsieve: Spark-native building blocks for article-triage data sets.

``functions``  column expressions over article text
``sources``    readers and writers for tables, sample files and side inputs
``operators``  DataFrame -> DataFrame steps (selection, splits, reports, ML)
``plans``      whole jobs composed from operators, and the query catalog
``streaming``  the row-local text steps on a stream of sample records
"""
