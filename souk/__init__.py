"""souk: commerce-event analytics written as Spark DataFrame jobs.

Sub-packages

* ``sources``   event schemas, table contracts, readers
* ``functions`` small Column / DataFrame helpers (time, money, filters, grouping)
* ``operators`` the analytics: pure ``DataFrame -> DataFrame`` functions
* ``sinks``     keyed writers (append, insert-ignore, upsert) and event encoding
* ``plans``     the scheduled jobs: which operator feeds which table
* ``streaming`` Structured Streaming jobs
* ``registry``  the queries and check SQL exposed by ``__spark_entry__``
"""
