"""Headline sentiment scoring and serving on Spark.

Entry points:

* ``bellwether.operators.scoring.score_text`` - lexicon scoring of a text column
* ``bellwether.operators.ingest`` - landed responses to news messages (flatten, dedupe, normalise)
* ``bellwether.operators.serving`` - validation, dedupe, counts, filters, cards, capped take
* ``bellwether.operators.timeline`` - retention, daily view, late rows, trend
* ``bellwether.streaming`` - the scoring, history and trend streams
* ``bellwether.jobs`` - the runnable streaming jobs
* ``bellwether.session.get_session`` - a session with the settings the jobs rely on
"""

__version__ = "0.1.0"
