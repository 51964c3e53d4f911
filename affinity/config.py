"""Run parameters.

``PUBLISHED`` holds the values of the published study; ``FIXTURE`` the values
used on the small driver tables (see FIXTURES.md: fewer interactions per user,
a larger sample, a looser Jaccard threshold).  Every operator takes the
numbers it needs explicitly, so a Config is only a convenient bundle.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Config:
    # Fixed values of the published study (must match for equal results).
    min_interactions: int = 100
    sample_fraction: float = 0.07
    history_size: int = 10
    holdout_size: int = 20
    sample_seed: int = 42
    split_seed: int = 42
    split_weights: tuple[float, float, float] = (0.6, 0.2, 0.2)
    seed_tuning: int = 42
    seed_test: int = 43
    top_k: int = 100
    min_readers: int = 50
    num_hash_tables: int = 5
    jaccard_distance: float = 0.5
    minhash_seed: int = 42
    alpha: float = 10.0
    beta: float = 20.0
    rating_weight: float = 5.0
    als_rank: int = 20
    als_explicit_rank: int = 10
    als_reg: float = 0.1
    als_iter: int = 10
    als_tune_iter: int = 5
    als_seed: int = 42
    checkpoint_interval: int = 2
    als_blocks: int = 10  # user / item blocks: also fixes the seeded start of the factors
    reader_chunk: int = 1000  # readers per token-list row
    recall_fraction: float = 0.05  # items that the recall of the hashed pairs is measured on
    vector_span: int = 4096  # vocabulary indices per sparse-vector row
    split_buckets: int = 64  # user buckets of the written split tables: about a task's worth of evaluation rows each
    deal_rows: int = 1_000_000  # rows of one user that one task writes
    explicit_grid: dict = field(default_factory=lambda: {"rank": [10, 20], "regParam": [0.01, 0.1, 1.0]})
    implicit_stage1_grid: dict = field(default_factory=lambda: {"rank": [10, 20], "regParam": [0.01, 0.1, 1.0]})
    implicit_stage2_grid: dict = field(default_factory=lambda: {"alpha": [1.0, 10.0], "beta": [20.0, 40.0]})
    implicit_stage1_alpha: float = 10.0
    implicit_stage1_beta: float = 40.0
    combined_grid: dict = field(default_factory=lambda: {"rating_weight": [1.0, 5.0, 10.0, 20.0]})

    @property
    def reserved(self) -> int:
        return self.history_size + self.holdout_size

    def with_(self, **kw) -> "Config":
        return replace(self, **kw)


PUBLISHED = Config()

# Parameters for the driver's small tables (FIXTURES.md "Parameters at fixture scale"):
# thresholds that fit the tables; every user, every published grid point and model size.
FIXTURE = Config(
    min_interactions=40,
    sample_fraction=1.0,
    min_readers=30,
    jaccard_distance=0.8,
    num_hash_tables=14,  # similar.choose_bands(1 - 0.8, 0.95): five tables find 0.67 of the pairs at this distance
    reader_chunk=16,
    recall_fraction=0.25,
    vector_span=64,
    split_buckets=8,
)

# The sampling operator itself (P1) and the reports about it.
SAMPLED = FIXTURE.with_(sample_fraction=0.5)
