"""Default parameters of an analysis run."""

from __future__ import annotations

from dataclasses import dataclass

# The defaults a run uses when the caller names none.
DEFAULT_START = "2023-10-31"
DEFAULT_END = "2024-10-31"
DEFAULT_PERIOD_FORMAT = "%Y-%m-%d %H:%i"
DEFAULT_THRESHOLD = 10
DEFAULT_USER_SAMPLE = 100
DEFAULT_BATCH_SIZE = 32
DEFAULT_COMPONENTS = 50
DEFAULT_CLUSTERS = 10
DEFAULT_RESTARTS = 10
DEFAULT_ITERATIONS = 300
DEFAULT_SEED = 42


@dataclass(frozen=True)
class AnalysisSettings:
    """Which comments to look at and when a commenter is suspicious."""

    start: str | None = DEFAULT_START
    end: str | None = DEFAULT_END
    period_format: str = DEFAULT_PERIOD_FORMAT
    threshold: int = DEFAULT_THRESHOLD
    user_sample: int = DEFAULT_USER_SAMPLE
    min_comments: int = 1
    peak_grain: str = "video"


@dataclass(frozen=True)
class ClusterSettings:
    """How texts are turned into vectors, reduced and grouped."""

    # Places that words are hashed into and weighted at. A power of two spreads them evenly.
    n_features: int = 1 << 18
    # Dimensions that the weighted words are projected to; principal components are taken of these.
    n_dimensions: int = 512
    n_components: int = DEFAULT_COMPONENTS
    n_clusters: int = DEFAULT_CLUSTERS
    restarts: int = DEFAULT_RESTARTS
    max_iterations: int = DEFAULT_ITERATIONS
    # Every restart gets the trial iterations; the cheapest ones go on until their centres rest.
    trial_iterations: int = 5
    finalists: int = 3
    # Points are dealt to so many tasks by hash, so that labels depend on nothing but data and settings.
    partitions: int = 16
    seed: int = DEFAULT_SEED
    n_samples: int = 5
