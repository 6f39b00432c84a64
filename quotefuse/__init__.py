"""quotefuse: a Spark-native market-quote pipeline.

Landed quote payloads -> Bronze -> Silver (normalise, fuse sources per
instrument in one shuffle, clean) -> Gold KPIs -> partitioned warehouse ->
reports, plus a Structured Streaming tick path and single-pass data-quality
checks. Everything is expressed with the DataFrame / SQL API; there is no
Python UDF anywhere in the library.
"""

__all__ = ["constants", "schemas", "session"]
