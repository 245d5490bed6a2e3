"""sonorant: a Spark-native engine for preparing large speech corpora.

Relational work is DataFrame expressions planned by Catalyst; Python runs only
inside Arrow batches (signal kernels, Unicode normalisation, tokenisation,
model scorers).
"""

__version__ = "0.1.0"
