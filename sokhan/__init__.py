"""Speech-text curation engine: DataFrame operators for Persian transcript corpora."""
