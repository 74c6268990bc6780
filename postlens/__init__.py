"""postlens: job-posting analytics as Spark DataFrame plans.

``sources`` read posting text (files, Kafka) and dictionaries; ``functions`` are column
expressions (parsing, salary buckets, tokens, JSON); ``operators`` are DataFrame transforms
(histograms, dimension counts, keyword and word counts, ranks, the result store, pair lookup);
``plans`` compose them into reports and jobs; ``streaming`` runs the report as one stateful query.
"""

__version__ = "0.1.0"
