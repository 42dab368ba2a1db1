"""tripmart: ride-hail trip marts on Spark.

Monthly trip files are ingested into a raw Parquet table, staged and keyed,
modelled into a star schema (one fact, three dimensions) and rolled up into
four reporting marts, with incremental high-water-mark, anti-join and upsert
logic plus data-quality checks. Everything is DataFrame / Spark SQL code;
there are no Python UDFs in the data path.

Layout:
    functions/  Column builders (surrogate keys, calendar, money, casts)
    sources/    table readers, seeds, landing files, raw-file ingest
    operators/  staging, star schema, marts, incremental writes, checks
    plans/      warehouse layout, end-to-end pipeline, dashboard slices,
                registered queries and their SQL oracles
    streaming/  Structured Streaming file ingest (availableNow + foreachBatch)
"""

__version__ = "0.1.0"
