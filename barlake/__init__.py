"""barlake: market-price bars and daily prices on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from Spark's
own expressions. Batch jobs, the streaming ``foreachBatch`` sink and the
registered queries all call the same functions.
"""

__version__ = "0.1.0"
