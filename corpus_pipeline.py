"""Corpus preparation, stage by stage."""

from __future__ import annotations

from siltworks.llm.pipeline import ORACLE_SQL, STAGES, run  # noqa: F401
