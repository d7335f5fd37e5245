"""Part of the speech-text curation engine."""
