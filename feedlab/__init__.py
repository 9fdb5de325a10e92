"""feedlab: content-feed features, models and metrics as Spark DataFrame operators.

Modules:

* ``feedlab.functions``  Column -> Column helpers (cleaning, term lists, tokenizer)
* ``feedlab.sources``    readers, sinks and canonical views over the test tables
* ``feedlab.operators``  DataFrame -> DataFrame operators (stats, joins, terms,
  text, features, models, evaluation, embeddings)
* ``feedlab.plans``      end-to-end plans, jobs over raw exports, the query registry
* ``feedlab.streaming``  the click/show aggregate maintained by Structured Streaming
* ``feedlab.constants``  values that must equal the source jobs'
* ``feedlab.session``    recommended settings, shared checkpoint folder, ``materialize``
"""

__version__ = "0.1.0"
