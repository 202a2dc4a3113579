"""claimsmith: a Spark-native claims analytics engine.

Layers: ``functions`` (Column -> Column helpers), ``operators`` (DataFrame ->
DataFrame: cleaning, synthesis, keys, star schema, quality, analytics),
``sources`` (readers, writers, test-data adapters), ``plans`` (stage
runners, registered queries and their SQL oracles).
"""
