"""Operations of a training-data pipeline: cleaning, filtering, near-duplicate
removal, decontamination, tokenisation and archives, each as a Spark job.

Nothing outside this subpackage imports it.
"""
