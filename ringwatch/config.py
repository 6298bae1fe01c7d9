"""Settings shared by the batch and streaming jobs."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RuleConfig:
    """Thresholds of the detection rules; the comparisons are strict except ``z_min_samples``."""

    large_amount: float = 100_000.0
    z_limit: float = 3.0
    z_min_samples: int = 3
    burst_count: int = 8


@dataclass(frozen=True)
class WindowConfig:
    """Event-time window settings, written as Spark interval strings."""

    size: str = "1 minute"
    slide: str = "10 seconds"
    watermark: str = "1 minute"


# Names written to stored rows.
REASON_LARGE = "LARGE_SINGLE_TRANSACTION"
REASON_SPIKE = "DYNAMIC_Z_SCORE_SPIKE"
REASON_BURST = "BOT_BURST_HIGH_FREQUENCY"
REASON_ML = "ML_ISOLATION_FOREST_ANOMALY"
NORMAL_LABEL = "normal"
UNKNOWN_TIER = "unknown"

# Model inputs, in order.
FEATURES = [
    "z_score",
    "tx_count",
    "avg_gas_fee",
    "graph_risk_score",
    "structural_novelty_score",
]

# Broadcast only tables measured to have at most this many rows.
BROADCAST_ROWS = 2_000_000

# Edges of one wallet beyond this number are split over several slots.
SLOT_EDGES = 250_000

# Betweenness of a graph measured to have at most this many edges is searched in tasks that each hold its edges.
TASK_EDGES = 10_000_000

# Senders with at least this many live transfers are dealt over so many tasks where their context is not broadcast.
BUSY_TRANSFERS = 1_000_000
BUSY_SLOTS = 32
