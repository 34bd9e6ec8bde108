"""The pipeline as a registered query."""

from __future__ import annotations

import corpus_pipeline

PIPELINE = {"pipeline": corpus_pipeline.run}
