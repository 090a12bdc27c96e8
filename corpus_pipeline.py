"""The corpus pipeline over documents: language ID, near-duplicates, secrets, mixing, packing.

STAGES holds (name, function) pairs; each function takes (spark, docs, sf_dir) and returns a DataFrame, which run()
writes as Parquet to the shared folder and rereads as the next one's docs. SQL can't express language ID, SimHash,
tokenization or the order along the curve, so there is no ORACLE_SQL; tests hold the stages against plain versions.
"""

from __future__ import annotations

from grantlens.llm.stages import STAGES, run

ORACLE_SQL = None

__all__ = ["ORACLE_SQL", "STAGES", "run"]
