"""Parameters of the analysis, with the defaults of a pipeline run."""

from __future__ import annotations

from dataclasses import dataclass

RANKS = ("d", "p", "c", "o", "f", "g", "s")
LEVELS = tuple(f"{r}HGT" for r in RANKS)


@dataclass(frozen=True)
class Config:
    minimum_orfs: int = 3
    max_overlap: float = 1.0
    merge_distance: int = 1000
    edge_padding: int = 1000
    slop: int = 1000
    min_fragments: int = 1
    min_returned: int = 1
    min_agreed: int = 1
    min_seq_id: float = 0.99  # of genes in a cluster
    min_cover: float = 0.8
    min_region_len: int = 0  # 0: off
    strict: bool = False  # all ranks above must agree, not the one above alone
    rip: tuple[float, float, float] = (20, 80, 80)  # identity, query cover, subject cover
    mge: tuple[float, float, float] = (20, 80, 80)
    arg: tuple[float, float, float] = (90, 50, 50)
