"""The pipeline as a registered query."""

import corpus_pipeline

QUERIES = {"pipeline": corpus_pipeline.run}
