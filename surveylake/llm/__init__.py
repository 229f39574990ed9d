"""Operators of a training-data pipeline, as Spark jobs.

simhash, chat, decontam, quality, warc, packing, licenses, urlfilter,
linededup, langid, vectorcodes, tokenspans and vectordedup hold one operator each; ``queries`` registers one query
per operator.  Nothing outside this folder, save ``corpus_pipeline.py`` and
the guarded import in ``__spark_entry__.py``, imports it.
"""

import sys

from pyspark import cloudpickle

# tasks get these functions by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
