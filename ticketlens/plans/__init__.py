"""Question plans.

questions  each question of the analysis as a composition of the operators
shared     the same questions from one GROUPING SETS scan per table
report     raw CSV -> cleaned table, the whole set of questions, chart tables
job        spark-submit entry point writing every result
catalog    registered queries over the driver's tables and their DuckDB oracles
"""
