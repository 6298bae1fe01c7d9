"""Fixed schemas of stored and exchanged tables."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_S, _D, _L, _B, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType(), T.TimestampType()

TRANSFER = _struct(
    tx_id=_S, wallet_address=_S, to_wallet=_S, amount_usd=_D, gas_fee=_D, true_label=_S, timestamp=_TS)

PROFILE = _struct(
    wallet_address=_S, first_seen_ts=_TS, historical_tx_count=_L, historical_risk_tier=_S)

CONTEXT = _struct(
    wallet_address=_S, historical_tx_count=_L, historical_risk_tier=_S, live_tx_count=_L,
    pagerank=_D, betweenness=_D, community_id=_L, in_wash_ring=_B,
    graph_risk_score=_D, structural_novelty_score=_D)

SENT = _struct(
    tx_id=_S, window_start=_S, wallet_address=_S, to_wallet=_S, amount_usd=_D, gas_fee=_D,
    tx_count=_L, timestamp=_TS, true_label=_S, z_score=_D, anomaly_reason=_S,
    ml_score=_D, ml_anomaly=_B)

BATCH_METRICS = _struct(
    batch_id=_L, status=_S, groups_updated=_L, transactions=_L, anomalies=_L, avg_z_score=_D)

ACTIVITY = _struct(wallet_address=_S, first_seen_ts=_TS, last_seen_ts=_TS, new_tx=_L)

FOREST = _struct(tree=_L, node=_L, feature=_L, split=_D, size=_L, depth=_L)
