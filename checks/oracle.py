"""The same results as SQL over the given tables, for a side-by-side check of values."""

from __future__ import annotations

from checks.queries import FOREST, PAGERANK_ROUNDS, SETTLED_DAMPING

_US_DAY = 86_400_000_000
_SEED = 42


def _draw(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 8))::bigint"


def _ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def _r(expr: str, name: str, places: int = 6) -> str:
    return f"round({expr}, {places}) + 0.0 AS {name}"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


# --- windows and rules -------------------------------------------------------------------------

EVENTS = """
ev AS (
  SELECT 'tx' || event_id AS tx_id, 'w' || user_id AS wallet_address, 'c_' || event_type AS to_wallet,
    value AS amount, json_extract(props, '$.k')::bigint / 1000.0 AS gas, ts,
    CASE WHEN value > 300 THEN 'flash_loan' WHEN json_extract(props, '$.k')::bigint % 50 = 0 THEN 'bot_burst'
      ELSE 'normal' END AS label
  FROM events)
"""


def _windows(name: str, where: str = "true") -> str:
    return f"""
{name} AS (
  SELECT *, (max_amount - mean_amount)
      / CASE WHEN stddev_amount IS NULL OR stddev_amount = 0 THEN 1.0 ELSE stddev_amount END AS z_score
  FROM (
    SELECT {_ts(f'make_timestamp((floor(epoch_us(ts) / {_US_DAY}.0)::bigint - k) * {_US_DAY})')} AS window_start,
      wallet_address, to_wallet, avg(amount) AS mean_amount, stddev_samp(amount) AS stddev_amount,
      max(amount) AS max_amount, sum(amount) AS total, count(tx_id) AS tx_count, avg(gas) AS avg_gas,
      arg_min(tx_id, (ts, tx_id)) AS sample_tx_id,
      coalesce(max(CASE WHEN label <> 'normal' THEN label END), max(label)) AS true_label, max(ts) AS last_seen
    FROM ev, unnest(range(0, 6)) AS t(k)
    WHERE {where}
    GROUP BY ALL)),
{name}_judged AS (
  SELECT *, CASE WHEN max_amount > 300 THEN 'LARGE_SINGLE_TRANSACTION'
      WHEN tx_count >= 3 AND abs(z_score) > 2.0 THEN 'DYNAMIC_Z_SCORE_SPIKE'
      WHEN tx_count > 8 THEN 'BOT_BURST_HIGH_FREQUENCY' END AS rule_reason
  FROM {name})
"""


# The inner select groups by every plain column, k included only through window_start.
def _grouped(sql: str) -> str:
    return sql.replace("GROUP BY ALL", "GROUP BY 1, 2, 3")


WIN = _with(EVENTS, _grouped(_windows("win")))

_WINDOW_COLS = f"""
  window_start, wallet_address, to_wallet, {_r('mean_amount', 'mean_amount')},
  {_r('stddev_amount', 'stddev_amount')}, max_amount, {_r('total', 'total_amount_usd', 2)}, tx_count,
  {_r('avg_gas', 'avg_gas_fee')}, sample_tx_id, true_label, {_ts('last_seen')} AS last_seen_ts"""

_STATS = f"{WIN} SELECT {_WINDOW_COLS} FROM win"
_CASCADE = f"{WIN} SELECT {_WINDOW_COLS}, {_r('z_score', 'z_score')}, rule_reason FROM win_judged"


def _edge_cols(extra: str = "") -> str:
    return f"""
  sample_tx_id AS tx_id, window_start, wallet_address, to_wallet, {_r('total', 'amount_usd', 2)},
  {_r('avg_gas', 'gas_fee')}, tx_count, {_ts('last_seen')} AS timestamp, true_label,
  {_r('z_score', 'z_score')}, rule_reason AS anomaly_reason{extra}"""


_HALF = "TIMESTAMP '2024-01-15 00:00:00'"
VERSIONS = _with(
    EVENTS, _grouped(_windows("early", f"ts < {_HALF}")), _grouped(_windows("win")),
    f"""
versions AS (
  SELECT *, 0::bigint AS batch_id FROM early_judged
  UNION ALL SELECT *, 1::bigint FROM win_judged WHERE last_seen >= {_HALF})""",
    """
batches AS (
  SELECT batch_id, 'active' AS status, count(*) AS groups_updated, sum(tx_count)::bigint AS transactions,
    count(rule_reason) AS anomalies, round(avg(coalesce(z_score, 0.0)), 2) AS avg_z_score
  FROM versions GROUP BY batch_id)""",
    """
recent AS (
  SELECT * FROM versions WHERE batch_id = (SELECT max(batch_id) FROM versions)
  ORDER BY window_start, wallet_address, to_wallet LIMIT 50)""")

_NEWEST = "ORDER BY last_seen DESC NULLS FIRST, wallet_address, to_wallet, window_start"

# --- profiles and wallets ----------------------------------------------------------------------


def _profiles(prefix: str) -> str:
    return f"""
profiles AS (
  SELECT '{prefix}' || c_custkey AS wallet_address, c_custkey, c_nationkey, c_acctbal, first_seen,
    coalesce(n_orders, 0) AS historical_tx_count,
    CASE WHEN c_acctbal < 0 THEN 'high' WHEN c_acctbal < 2500 THEN 'medium' ELSE 'low' END AS historical_risk_tier
  FROM customer LEFT JOIN (
    SELECT o_custkey, min(o_orderdate) AS first_seen, count(*) AS n_orders FROM orders GROUP BY 1)
  ON c_custkey = o_custkey)
"""


def _activity(source: str) -> str:
    return f"""
sends AS (
  SELECT wallet_address, min(ts) AS seen_first, max(ts) AS seen_last, count(DISTINCT tx_id) AS n
  FROM {source} GROUP BY 1),
activity AS (
  SELECT coalesce(s.wallet_address, r.to_wallet) AS wallet_address, seen_first, seen_last,
    coalesce(n, 0) AS live_tx_count
  FROM sends s FULL JOIN (SELECT DISTINCT to_wallet FROM {source}) r ON s.wallet_address = r.to_wallet)
"""


PURCHASES = """
purchases AS (
  SELECT 'tx' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS tx_id,
    'cu' || o_custkey AS wallet_address, 'su' || l_suppkey AS to_wallet,
    l_extendedprice::decimal(18,2) AS amount, l_shipdate AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""

CONTEXT = _profiles("w") + """,
vectors AS (
  SELECT p.*, historical_tx_count / 10.0 AS pagerank, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS betw,
    embedding::double[] AS e
  FROM profiles p LEFT JOIN embeddings ON vec_id = c_custkey),
centroid AS (
  SELECT list(m ORDER BY i) AS c FROM (
    SELECT i, avg(x) AS m FROM (
      SELECT generate_subscripts(e, 1) AS i, unnest(e) AS x FROM vectors WHERE e IS NOT NULL) GROUP BY i)),
distances AS (SELECT v.*, list_distance(e, c) AS dist FROM vectors v, centroid),
bounds AS (
  SELECT min(pagerank) AS p0, max(pagerank) AS p1, min(coalesce(betw, 0)) AS b0, max(coalesce(betw, 0)) AS b1,
    min(dist) AS d0, max(dist) AS d1 FROM distances),
context AS (
  SELECT wallet_address, historical_tx_count, historical_risk_tier, 0::bigint AS live_tx_count, pagerank,
    coalesce(betw, 0.0) AS betweenness,
    (CASE WHEN c_nationkey > 0 THEN c_nationkey ELSE -1 END)::bigint AS community_id,
    historical_risk_tier = 'high' AS in_wash_ring,
    round(least(1.0, 0.4 * (pagerank - p0) / CASE WHEN p1 = p0 THEN 1.0 ELSE p1 - p0 END
      + 0.3 * (coalesce(betw, 0.0) - b0) / CASE WHEN b1 = b0 THEN 1.0 ELSE b1 - b0 END
      + CASE WHEN historical_risk_tier = 'high' THEN 0.3 ELSE 0.0 END), 6) AS graph_risk_score,
    round(coalesce((dist - d0) / CASE WHEN d1 = d0 THEN 1.0 ELSE d1 - d0 END, 0.0), 6)
      AS structural_novelty_score
  FROM distances, bounds)
"""

# --- forest ------------------------------------------------------------------------------------

FEATURES = """
features AS (
  SELECT w.wallet_address, to_wallet, window_start, round(coalesce(z_score, 0.0), 6) + 0.0 AS z_score,
    tx_count::double AS tx_count, round(coalesce(avg_gas, 0.0), 6) AS avg_gas_fee,
    coalesce(graph_risk_score, 0.0) AS graph_risk_score,
    coalesce(structural_novelty_score, 0.0) AS structural_novelty_score
  FROM win w LEFT JOIN context c ON w.wallet_address = c.wallet_address)
"""


def _forest() -> str:
    t, psi, h = FOREST.trees, FOREST.rows_per_tree, FOREST.height
    key = "concat_ws('|', wallet_address, to_wallet, window_start)"
    parts = [f"""
inputs AS MATERIALIZED (
  SELECT *, {key} AS k,
    [z_score, tx_count, avg_gas_fee, graph_risk_score, structural_novelty_score] AS x FROM features),
size AS (
  SELECT n, least({t}, greatest(1, ceil({t} * {psi} / n)))::bigint AS g
  FROM (SELECT count(*)::double AS n FROM inputs)),
s0 AS MATERIALIZED (
  SELECT i + g * ({_draw('k', 'i', str(_SEED), "'tree'")} % (({t - 1} - i) // g + 1)) AS tree, 1::bigint AS node, x
  FROM (SELECT k, x, g, n, unnest(range(0, g)) AS i FROM inputs, size)
  WHERE {_draw('k', 'i', str(_SEED))} / 4294967296.0 < least(1.0, {t} * {psi} / (n * g)))"""]
    for d in range(h + 1):
        low = ", ".join(f"min(x[{i}])" for i in range(1, 6))
        high = ", ".join(f"max(x[{i}])" for i in range(1, 6))
        varied = "list_filter([1, 2, 3, 4, 5], lambda i: high[i] > low[i])" if d < h else "[]::integer[]"
        parts.append(f"""
n{d} AS MATERIALIZED (
  SELECT tree, node, size, {d}::bigint AS depth, f,
    low[f] + ({_draw('tree', 'node', "'split'", str(_SEED))} / 4294967296.0) * (high[f] - low[f]) AS split
  FROM (SELECT *, varied[1 + ({_draw('tree', 'node', "'feature'", str(_SEED))} % greatest(len(varied), 1))] AS f
    FROM (SELECT *, {varied} AS varied FROM (
      SELECT tree, node, count(*) AS size, [{low}] AS low, [{high}] AS high FROM s{d} GROUP BY 1, 2)))),
s{d + 1} AS MATERIALIZED (
  SELECT s.tree, 2 * s.node + (x[f] > split)::bigint AS node, x
  FROM s{d} s JOIN n{d} n ON s.tree = n.tree AND s.node = n.node WHERE f IS NOT NULL)""")
    union = " UNION ALL ".join(f"SELECT * FROM n{d}" for d in range(h + 1))
    parts.append(f"""
forest AS MATERIALIZED (
  SELECT tree, node, coalesce(f - 1, -1)::bigint AS feature, split, size, depth FROM ({union}))""")
    return ",".join(parts)


def _c(n: str) -> str:
    return (f"CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 "
            f"ELSE 2 * (ln({n} - 1) + 0.5772156649) - 2.0 * ({n} - 1) / {n} END")


def _walk() -> str:
    parts = [f"""
roots AS (SELECT tree, {_c('size')} AS c FROM forest WHERE node = 1 AND size > 1),
p0 AS (SELECT k, x, tree, 1::bigint AS node FROM inputs, roots)"""]
    for d in range(FOREST.height):
        parts.append(f"""
p{d + 1} AS (
  SELECT k, x, p.tree, CASE WHEN feature >= 0 THEN 2 * p.node + (x[feature + 1] > split)::bigint ELSE p.node END AS node
  FROM p{d} p JOIN forest f ON p.tree = f.tree AND p.node = f.node)""")
    parts.append(f"""
raw AS MATERIALIZED (
  SELECT k, -pow(2.0, -avg((depth + {_c('size')}) / c)) AS raw_score
  FROM p{FOREST.height} p JOIN forest f ON p.tree = f.tree AND p.node = f.node JOIN roots r ON r.tree = p.tree
  GROUP BY k),
cut AS (SELECT quantile_cont(raw_score, {FOREST.contamination}) AS o FROM raw),
scored AS (
  SELECT i.*, raw_score, raw_score - o AS ml_score FROM inputs i JOIN raw USING (k), cut)""")
    return ",".join(parts)


MODEL = _with(EVENTS, _grouped(_windows("win")), CONTEXT, FEATURES, _forest())
SCORED = MODEL + "," + _walk()

# --- graph -------------------------------------------------------------------------------------

LOTS = """
lots AS (
  SELECT l_partkey, o_custkey, l_orderkey, l_extendedprice::decimal(18,2) AS w, l_shipdate,
    floor(datediff('day', DATE '1970-01-01', l_shipdate::date) / 14.0) AS lot
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
openers AS (
  SELECT l_partkey, lot, arg_min(o_custkey, (l_shipdate, l_orderkey, o_custkey)) AS opener FROM lots GROUP BY 1, 2),
e AS MATERIALIZED (
  SELECT 'cu' || o_custkey AS s, 'cu' || opener AS d, sum(w)::double AS w, count(*) AS n
  FROM lots JOIN openers USING (l_partkey, lot) WHERE o_custkey <> opener GROUP BY 1, 2),
nodes AS MATERIALIZED (SELECT DISTINCT unnest([s, d]) AS node FROM e)
"""

PURCHASE_EDGES = PURCHASES + """,
e AS MATERIALIZED (
  SELECT wallet_address AS s, to_wallet AS d, sum(amount)::double AS w, count(*) AS n FROM purchases GROUP BY 1, 2),
nodes AS MATERIALIZED (SELECT DISTINCT unnest([s, d]) AS node FROM e)
"""


def _pagerank(rounds: int, damping: float = 0.85) -> str:
    base = round(1 - damping, 6)
    parts = [f"""
share AS MATERIALIZED (SELECT s, d, w / sum(w) OVER (PARTITION BY s) AS p FROM e),
pr0 AS (SELECT node, {base} AS pr FROM nodes)"""]
    for i in range(1, rounds + 1):
        parts.append(f"""
pr{i} AS MATERIALIZED (
  SELECT node, {base} + {damping} * coalesce(r, 0.0) AS pr FROM nodes LEFT JOIN (
    SELECT d, sum(pr * p) AS r FROM share JOIN pr{i - 1} ON node = s GROUP BY d) ON node = d)""")
    parts.append(f"ranks AS (SELECT node, pr AS pagerank FROM pr{rounds})")
    return ",".join(parts)


# Simple rings start at their smallest wallet; trails use no edge twice and count once per start.
RINGS = """
walks AS (
  SELECT s AS st, d AS cur, [s, d] AS path, 1 AS hops FROM e WHERE d > s
  UNION ALL
  SELECT w.st, e.d, list_append(w.path, e.d), hops + 1 FROM walks w JOIN e ON w.cur = e.s
  WHERE hops < 8 AND w.cur <> w.st AND (e.d = w.st OR (e.d > w.st AND NOT list_contains(w.path, e.d)))),
rings AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY hops, ring_key) - 1 AS ring_id, ring_key, st AS start_address,
    hops::bigint AS ring_length, members
  FROM (SELECT st, hops, path[1:hops] AS members, array_to_string(path[1:hops], '>') AS ring_key
    FROM walks WHERE cur = st AND hops >= 3))
"""
TRAILS = """
walks AS (
  SELECT s AS st, d AS cur, [s, d] AS path, [s || '>' || d] AS used, 1 AS hops FROM e
  UNION ALL
  SELECT w.st, e.d, list_append(w.path, e.d), list_append(used, e.s || '>' || e.d), hops + 1
  FROM walks w JOIN e ON w.cur = e.s WHERE hops < 8 AND NOT list_contains(used, e.s || '>' || e.d)),
rings AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY hops, ring_key) - 1 AS ring_id, ring_key, st AS start_address,
    hops::bigint AS ring_length
  FROM (SELECT st, hops, array_to_string(path, '>') AS ring_key FROM walks WHERE cur = st AND hops >= 3))
"""
_RING_COLS = "ring_id, ring_key, start_address, ring_length"


def _with_recursive(*parts: str) -> str:
    return _with(*parts).replace("WITH ", "WITH RECURSIVE ", 1)


FLAGS = """
member AS (SELECT m AS node, min(ring_id) AS wash_ring_id FROM (
  SELECT ring_id, unnest(members) AS m FROM rings) GROUP BY 1),
flags AS (
  SELECT node, wash_ring_id IS NOT NULL AS in_wash_ring, wash_ring_id FROM nodes LEFT JOIN member USING (node))
"""

GRAPH_WALLETS = _with_recursive(
    LOTS, RINGS, FLAGS, _pagerank(PAGERANK_ROUNDS), _profiles("cu"), """
wallets AS MATERIALIZED (
  SELECT wallet_address, first_seen, historical_tx_count, historical_risk_tier,
    c_nationkey::bigint AS community_id, round(pagerank, 6) AS pagerank, in_wash_ring, wash_ring_id
  FROM profiles LEFT JOIN (SELECT * FROM ranks JOIN flags USING (node)) ON node = wallet_address)""", """
ring_list AS (
  SELECT wash_ring_id AS ring_id, list(wallet_address ORDER BY wallet_address) AS wallets
  FROM wallets WHERE in_wash_ring GROUP BY 1)""", EVENTS, _grouped(_windows("win")), f"""
top AS (SELECT * FROM wallets WHERE pagerank IS NOT NULL ORDER BY pagerank DESC, wallet_address LIMIT 15)""", f"""
newest AS (SELECT * FROM win_judged {_NEWEST} LIMIT 150)""")


def _betweenness(levels: int) -> str:
    parts = ["l0 AS MATERIALIZED (SELECT DISTINCT s, s AS v, 1.0::double AS paths FROM e)",
             "v0 AS MATERIALIZED (SELECT s, v FROM l0)"]
    for k in range(1, levels + 1):
        parts.append(f"""
l{k} AS MATERIALIZED (
  SELECT f.s, e.d AS v, sum(f.paths) AS paths FROM l{k - 1} f JOIN e ON f.v = e.s
  WHERE NOT EXISTS (SELECT 1 FROM v{k - 1} x WHERE x.s = f.s AND x.v = e.d) GROUP BY 1, 2),
v{k} AS MATERIALIZED (SELECT * FROM v{k - 1} UNION ALL SELECT s, v FROM l{k})""")
    parts.append(f"b{levels} AS (SELECT s, v, paths, 0.0::double AS share FROM l{levels})")
    for k in range(levels - 1, 0, -1):
        parts.append(f"""
b{k} AS MATERIALIZED (
  SELECT l.s, l.v, l.paths, l.paths * coalesce(a.pp, 0.0) AS share FROM l{k} l LEFT JOIN (
    SELECT b.s, e.s AS v, sum((1 + b.share) / b.paths) AS pp FROM b{k + 1} b JOIN e ON e.d = b.v GROUP BY 1, 2) a
  ON l.s = a.s AND l.v = a.v)""")
    union = " UNION ALL ".join(f"SELECT v, share FROM b{k}" for k in range(1, levels + 1))
    parts.append(f"""
central AS MATERIALIZED (
  SELECT node, coalesce(t, 0.0) AS betweenness FROM nodes LEFT JOIN (SELECT v, sum(share) AS t FROM ({union}) GROUP BY v) ON v = node)""")
    return ",".join(parts)


def _fastrp() -> str:
    dim = range(8)
    face = [_draw("node", str(i), str(_SEED)) + " % 6" for i in dim]
    start = ", ".join(
        f"CASE {f} WHEN 0 THEN sqrt(3.0) WHEN 1 THEN -sqrt(3.0) ELSE 0.0 END AS v{i}" for i, f in zip(dim, face))
    parts = [f"r0 AS MATERIALIZED (SELECT node, {start} FROM nodes)"]
    for r in (1, 2, 3):
        means = ", ".join(f"sum(w * v{i}) / sum(w) AS m{i}" for i in dim)
        norm = "sqrt(" + " + ".join(f"m{i} * m{i}" for i in dim) + ")"
        unit = ", ".join(f"coalesce(CASE WHEN z > 0 THEN m{i} / z ELSE m{i} END, 0.0) AS v{i}" for i in dim)
        parts.append(f"""
r{r} AS MATERIALIZED (
  SELECT node, {unit} FROM nodes LEFT JOIN (
    SELECT *, {norm} AS z FROM (SELECT e.s, {means} FROM e JOIN r{r - 1} ON node = e.d GROUP BY e.s)) ON s = node)""")
    cols = ", ".join(f"r2.v{i} + r3.v{i} AS e{i}" for i in dim)
    return ",".join([*parts, f"""
embedded AS MATERIALIZED (SELECT node, {cols} FROM r2 JOIN r3 USING (node))"""])


# The published context: profiles, ranks, centrality, rings and vectors of all customers, filled, scaled and scored.
REFRESHED = """
linked AS (
  SELECT node, pagerank, betweenness, in_wash_ring, [e0, e1, e2, e3, e4, e5, e6, e7] AS e
  FROM ranks JOIN central USING (node) JOIN flags USING (node) JOIN embedded USING (node)),
known AS MATERIALIZED (
  SELECT wallet_address, historical_tx_count, historical_risk_tier, 0::bigint AS live_tx_count,
    coalesce(pagerank, 0.0) AS pagerank, coalesce(betweenness, 0.0) AS betweenness, node IS NOT NULL AS in_community,
    coalesce(in_wash_ring, false) AS in_wash_ring, e
  FROM profiles LEFT JOIN linked ON node = wallet_address),
middle AS (
  SELECT list(m ORDER BY i) AS c FROM (
    SELECT i, avg(x) AS m FROM (SELECT generate_subscripts(e, 1) AS i, unnest(e) AS x FROM known WHERE e IS NOT NULL) GROUP BY i)),
apart AS MATERIALIZED (SELECT known.*, list_distance(e, c) AS dist FROM known, middle),
ends AS (
  SELECT min(pagerank) AS p0, max(pagerank) AS p1, min(betweenness) AS b0, max(betweenness) AS b1, min(dist) AS d0, max(dist) AS d1
  FROM apart)
SELECT wallet_address, historical_tx_count, historical_risk_tier, live_tx_count, round(pagerank, 6) AS pagerank,
  round(betweenness, 4) AS betweenness, in_community, in_wash_ring,
  round(least(1.0, 0.4 * (pagerank - p0) / (p1 - p0) + 0.3 * (betweenness - b0) / (b1 - b0)
    + CASE WHEN in_wash_ring THEN 0.3 ELSE 0.0 END), 5) AS graph_risk_score,
  round(coalesce((dist - d0) / (d1 - d0), 0.0), 5) AS structural_novelty_score
FROM apart, ends"""


def _louvain_rounds() -> str:
    parts = [LOTS.strip(), """
sym AS MATERIALIZED (
  SELECT a, b, sum(w)::bigint AS w FROM (
    SELECT s AS a, d AS b, round(w * 100)::bigint AS w FROM e UNION ALL
    SELECT d, s, round(w * 100)::bigint FROM e) GROUP BY 1, 2),
m AS (SELECT sum(w)::hugeint AS m2 FROM sym),
g0 AS MATERIALIZED (SELECT a AS node, sum(w)::bigint AS k, a AS community FROM sym GROUP BY a)"""]
    for i in range(2):
        parts.append(f"""
o{i} AS MATERIALIZED (
  SELECT node, c, sum(w) AS w FROM (
    SELECT a AS node, community AS c, w FROM sym JOIN g{i} ON node = b WHERE a <> b
    UNION ALL SELECT node, community, 0 FROM g{i}) GROUP BY 1, 2),
q{i} AS MATERIALIZED (
  SELECT o.node, g.k, g.community, o.c,
    m2 * o.w::hugeint - g.k::hugeint * (t.kc - CASE WHEN o.c = g.community THEN g.k ELSE 0 END)::hugeint AS score
  FROM o{i} o JOIN g{i} g ON o.node = g.node
  JOIN (SELECT community AS c, sum(k) AS kc FROM g{i} GROUP BY 1) t ON t.c = o.c, m),
g{i + 1} AS MATERIALIZED (
  SELECT node, k, CASE WHEN ({_draw('node', str(i // 2), str(_SEED))} + {i}) % 2 = 0 AND best > stay THEN bc ELSE community END
    AS community
  FROM (SELECT node, k, community, max(score) AS best, arg_min(c, (-score, c)) AS bc,
      max(CASE WHEN c = community THEN score END) AS stay
    FROM q{i} GROUP BY 1, 2, 3))""")
    return "WITH " + ",".join(parts)


LOUVAIN = _louvain_rounds()

# --- evaluation --------------------------------------------------------------------------------

CELLS = """
lab AS (
  SELECT toxic AS y, (n_chars > 2000)::int AS a, (quality = 0)::int AS b FROM labels JOIN documents USING (doc_id)),
said AS (
  SELECT 'rule_based' AS detector, y, a AS p FROM lab UNION ALL SELECT 'isolation_forest', y, b FROM lab
  UNION ALL SELECT 'combined', y, greatest(a, b) FROM lab)
"""
WINDOW_CELLS = EVENTS + "," + _grouped(_windows("win")) + """,
lab AS (SELECT (true_label <> 'normal')::int AS y, (rule_reason IS NOT NULL)::int AS a FROM win_judged),
said AS (
  SELECT 'rule_based' AS detector, y, a AS p FROM lab UNION ALL SELECT 'isolation_forest', y, 0 FROM lab
  UNION ALL SELECT 'combined', y, a FROM lab)
"""
SCORED_CELLS = """
lab AS (
  SELECT (w.true_label <> 'normal')::int AS y, (w.rule_reason IS NOT NULL)::int AS a,
    coalesce(s.ml_score < 0, false)::int AS b
  FROM scored s JOIN win_judged w USING (wallet_address, to_wallet, window_start) WHERE w.true_label IS NOT NULL),
said AS (
  SELECT 'rule_based' AS detector, y, a AS p FROM lab UNION ALL SELECT 'isolation_forest', y, b FROM lab
  UNION ALL SELECT 'combined', y, greatest(a, b) FROM lab)
"""
# A transfer is judged by the six windows that start on its day or on one of the five days before.
TRANSFER_CELLS = f"""
judged AS MATERIALIZED (
  SELECT wallet_address, to_wallet, window_start, (w.rule_reason IS NOT NULL)::int AS a, coalesce(s.ml_score < 0, false)::int AS b
  FROM scored s JOIN win_judged w USING (wallet_address, to_wallet, window_start)),
lab AS (
  SELECT (any_value(label) <> 'normal')::int AS y, coalesce(max(a), 0) AS a, coalesce(max(b), 0) AS b
  FROM (SELECT ev.*, row_number() OVER () AS r, t.k FROM ev, unnest(range(0, 6)) AS t(k)) x LEFT JOIN judged j
  ON j.wallet_address = x.wallet_address AND j.to_wallet = x.to_wallet
    AND j.window_start = {_ts(f'make_timestamp((floor(epoch_us(ts) / {_US_DAY}.0)::bigint - k) * {_US_DAY})')}
  WHERE label IS NOT NULL GROUP BY tx_id),
said AS (
  SELECT 'rule_based' AS detector, y, a AS p FROM lab UNION ALL SELECT 'isolation_forest', y, b FROM lab
  UNION ALL SELECT 'combined', y, greatest(a, b) FROM lab)
"""
MATRIX = """
matrix AS (
  SELECT detector, count(*) FILTER (y = 0 AND p = 0) AS tn, count(*) FILTER (y = 0 AND p = 1) AS fp,
    count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 1 AND p = 1) AS tp
  FROM said GROUP BY 1)
"""
REPORT = MATRIX + """,
classes AS (
  SELECT detector, 'normal' AS class, tn AS hit, fn AS alarm, fp AS miss FROM matrix
  UNION ALL SELECT detector, 'anomaly', tp, fp, fn FROM matrix),
rates AS (
  SELECT detector, class, CASE WHEN hit + alarm = 0 THEN 0.0 ELSE hit / (hit + alarm) END AS p,
    CASE WHEN hit + miss = 0 THEN 0.0 ELSE hit / (hit + miss) END AS r, (hit + miss)::double AS support FROM classes),
scores AS (
  SELECT detector, class, p AS precision, r AS recall,
    CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1, support FROM rates),
sums AS (
  SELECT * FROM scores
  UNION ALL SELECT detector, 'macro', avg(precision), avg(recall), avg(f1), sum(support) FROM scores GROUP BY 1
  UNION ALL SELECT detector, 'weighted', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM scores GROUP BY 1)
"""
_REPORT_OUT = """
SELECT detector, class, metric, round(value, 6) AS value FROM (
  SELECT detector, class, 'precision' AS metric, precision AS value FROM sums
  UNION ALL SELECT detector, class, 'recall', recall FROM sums
  UNION ALL SELECT detector, class, 'f1', f1 FROM sums
  UNION ALL SELECT detector, class, 'support', support FROM sums
  UNION ALL SELECT detector, 'all', 'accuracy', (tn + tp) / (tn + fp + fn + tp) FROM matrix)
"""

_PAYLOAD = """
msg AS (
  SELECT *, CASE WHEN event_type = 'error' THEN 'malformed_payload'
    WHEN event_type = 'signup' THEN 'missing_receiver' END AS reject_reason
  FROM events)
"""

ORACLE: dict[str, str] = {
    "sliding_pair_stats": _STATS,
    "sliding_pair_stats_by_pane": _STATS,
    "rule_cascade": _CASCADE,
    "flagged_windows": _CASCADE + " WHERE rule_reason IS NOT NULL",
    "rule_reason_counts": f"{WIN} SELECT rule_reason, count(*) AS n FROM win_judged GROUP BY 1",
    "json_decode": _with(_PAYLOAD) + """
SELECT 'tx' || event_id AS tx_id, 'w' || user_id AS wallet_address, 'c_' || event_type AS to_wallet,
  value AS amount_usd, json_extract(props, '$.k')::double AS gas_fee,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS timestamp
FROM msg WHERE reject_reason IS NULL""",
    "reject_counts": _with(_PAYLOAD) + " SELECT reject_reason, count(*) AS n FROM msg GROUP BY 1",
    "profile_scan": _with(_profiles("w")) + f"""
SELECT wallet_address, {_ts('first_seen')} AS first_seen_ts, historical_tx_count, historical_risk_tier FROM profiles""",
    "profile_upsert": _with(EVENTS, _activity("ev"), _profiles("w")) + f"""
SELECT coalesce(p.wallet_address, a.wallet_address) AS wallet_address,
  {_ts('CASE WHEN p.wallet_address IS NOT NULL THEN first_seen ELSE seen_first END')} AS first_seen_ts,
  historical_tx_count, historical_risk_tier, live_tx_count
FROM activity a FULL JOIN profiles p ON a.wallet_address = p.wallet_address""",
    "wallet_activity": _with(PURCHASES, _activity("purchases")) + f"""
SELECT wallet_address, {_ts('seen_first')} AS first_seen_ts, {_ts('seen_last')} AS last_seen_ts, live_tx_count
FROM activity""",
    "wallet_activity_merged": _with(PURCHASES, _activity("purchases")) + f"""
SELECT wallet_address, {_ts('seen_first')} AS first_seen_ts, {_ts('seen_last')} AS last_seen_ts, live_tx_count
FROM activity""",
    "wallet_table": _with(EVENTS, _activity("ev"), _profiles("w")) + f"""
SELECT coalesce(p.wallet_address, a.wallet_address) AS wallet_address,
  {_ts('coalesce(first_seen, seen_first)')} AS first_seen_ts,
  coalesce(historical_tx_count, 0) AS historical_tx_count,
  coalesce(historical_risk_tier, 'unknown') AS historical_risk_tier, coalesce(live_tx_count, 0) AS live_tx_count,
  {_ts('seen_last')} AS last_seen_ts
FROM activity a FULL JOIN profiles p ON a.wallet_address = p.wallet_address""",
    "missing_receivers": _with(EVENTS, _profiles("w")) + """
SELECT wallet_address, historical_tx_count, historical_risk_tier, 0::bigint AS live_tx_count FROM profiles
UNION ALL
SELECT DISTINCT to_wallet, NULL::bigint, 'unknown', 0::bigint FROM ev
WHERE to_wallet NOT IN (SELECT wallet_address FROM profiles)""",
    "key_duplicates": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "edge_latest": VERSIONS + f"""
SELECT {_edge_cols(', batch_id')} FROM (
  SELECT *, row_number() OVER (PARTITION BY wallet_address, to_wallet, window_start ORDER BY batch_id DESC) AS rn
  FROM versions) WHERE rn = 1""",
    "batch_metrics": VERSIONS + " SELECT * FROM batches",
    "metrics_summary": VERSIONS + """, last AS (
  SELECT * FROM versions WHERE batch_id = (SELECT max(batch_id) FROM versions))
SELECT 'active' AS status, sum(groups_updated)::bigint AS total_processed, sum(anomalies)::bigint AS total_anomalies,
  max(batch_id) AS last_batch_id, arg_max(avg_z_score, batch_id) AS avg_z_score,
  (SELECT count(*) FROM last) AS recent_batch_record_count,
  (SELECT round(sum(coalesce(avg_gas, 0.0)) / count(*), 4) FROM last) AS recent_avg_gas_fee,
  (SELECT sum(tx_count)::bigint FROM last) AS recent_total_tx_count
FROM batches""",
    "recent_batch_rows": VERSIONS + f" SELECT {_edge_cols(', batch_id')} FROM recent",
    "metrics_recent_records": VERSIONS + f" SELECT {_edge_cols(', batch_id')} FROM recent ORDER BY window_start, wallet_address, to_wallet LIMIT 20",
    "stream_detection": f"{WIN} SELECT {_edge_cols()} FROM win_judged",
    "stream_detection_final": f"{WIN} SELECT {_edge_cols()} FROM win_judged",
    "stream_detection_scored": SCORED + """
SELECT wallet_address, to_wallet, window_start, w.tx_count, round(ml_score, 4) + 0.0 AS ml_score, ml_score < 0 AS ml_anomaly,
  coalesce(rule_reason, CASE WHEN ml_score < 0 THEN 'ML_ISOLATION_FOREST_ANOMALY' END) AS anomaly_reason
FROM scored s JOIN win_judged w USING (wallet_address, to_wallet, window_start)""",
    "recent_edges": f"""{WIN}
SELECT wallet_address AS from_wallet, to_wallet, {_r('total', 'amount_usd', 2)}, rule_reason AS anomaly_reason,
  {_ts('last_seen')} AS timestamp FROM win_judged {_NEWEST} LIMIT 150""",
    "transaction_listing": f"""{WIN}
SELECT sample_tx_id AS tx_id, wallet_address, to_wallet, {_r('total', 'amount_usd', 2)}, {_r('avg_gas', 'gas_fee')},
  rule_reason AS anomaly_reason, {_r('z_score', 'z_score')}, NULL::double AS ml_score, false AS ml_anomaly,
  {_ts('last_seen')} AS timestamp FROM win_judged {_NEWEST} LIMIT 20""",
    "wallet_context": _with(CONTEXT) + " SELECT * FROM context",
    "structural_novelty": """
WITH v AS (SELECT vec_id, embedding::double[] AS e FROM embeddings),
c AS (
  SELECT list(m ORDER BY i) AS c FROM (
    SELECT i, avg(x) AS m FROM (SELECT generate_subscripts(e, 1) AS i, unnest(e) AS x FROM v) GROUP BY i)),
d AS (SELECT vec_id, list_distance(e, c) AS dist FROM v, c),
b AS (SELECT min(dist) AS d0, max(dist) AS d1 FROM d)
SELECT vec_id, round((dist - d0) / (d1 - d0), 6) AS structural_novelty_score FROM d, b""",
    "enrich_left": _with(EVENTS, _grouped(_windows("win")), CONTEXT) + """
SELECT window_start, w.wallet_address, to_wallet, tx_count, historical_tx_count, historical_risk_tier,
  live_tx_count, community_id, in_wash_ring, graph_risk_score, structural_novelty_score
FROM win w LEFT JOIN context c ON w.wallet_address = c.wallet_address""",
    "training_features": _with(EVENTS, _grouped(_windows("win")), CONTEXT, FEATURES) + " SELECT * FROM features",
    "forest_nodes": MODEL + " SELECT tree, node, feature, round(split, 6) AS split, size, depth FROM forest",
    "forest_scores": SCORED + """
SELECT wallet_address, to_wallet, window_start, round(raw_score, 6) AS raw_score FROM scored""",
    "forest_reloaded": SCORED + """
SELECT wallet_address, to_wallet, window_start, round(raw_score, 6) AS raw_score FROM scored""",
    "score_cutoff": f"SELECT round(quantile_cont(value, {FOREST.contamination}), 6) AS cutoff FROM events",
    "forest_summary": SCORED + """
SELECT count(*) AS n_rows, count(*) FILTER (ml_score < 0) AS n_flagged,
  round(count(*) FILTER (ml_score < 0) / count(*), 6) AS flagged_share, round(min(ml_score), 6) AS min_score,
  round(max(ml_score), 6) AS max_score, round(avg(ml_score), 6) AS mean_score FROM scored""",
    "ml_verdict": SCORED + """
SELECT coalesce(rule_reason, CASE WHEN ml_score < 0 THEN 'ML_ISOLATION_FOREST_ANOMALY' END) AS anomaly_reason,
  ml_score < 0 AS ml_anomaly, count(*) AS n
FROM scored s JOIN win_judged w USING (wallet_address, to_wallet, window_start) GROUP BY 1, 2""",
    "edge_collapse": _with(PURCHASE_EDGES) + " SELECT s AS src, d AS dst, round(w, 2) AS w, n FROM e",
    "edge_dedup": _with(PURCHASE_EDGES) + " SELECT s AS src, d AS dst FROM e",
    "graph_nodes": _with(PURCHASE_EDGES) + " SELECT node FROM nodes",
    "pagerank_k": _with(LOTS, _pagerank(PAGERANK_ROUNDS)) + " SELECT node, round(pagerank, 6) AS pagerank FROM ranks",
    "pagerank_purchases": _with(PURCHASE_EDGES, _pagerank(20)) + """
SELECT node, round(pagerank, 6) AS pagerank FROM ranks""",
    "rings_simple": _with_recursive(LOTS, RINGS) + f" SELECT {_RING_COLS} FROM rings",
    "rings_trail": _with_recursive(LOTS, TRAILS) + f" SELECT {_RING_COLS} FROM rings",
    "rings_first_100": _with_recursive(LOTS, TRAILS) + f" SELECT {_RING_COLS} FROM rings WHERE ring_id < 100",
    "ring_flags": _with_recursive(LOTS, RINGS, FLAGS) + " SELECT * FROM flags",
    "wash_rings": GRAPH_WALLETS + " SELECT ring_id, array_to_string(wallets, ',') AS wallets FROM ring_list",
    "top_risk_wallets": GRAPH_WALLETS + """
SELECT wallet_address, pagerank, community_id, coalesce(in_wash_ring, false) AS in_wash_ring, historical_risk_tier
FROM wallets WHERE pagerank IS NOT NULL ORDER BY pagerank DESC, wallet_address LIMIT 20""",
    "wallet_listing": GRAPH_WALLETS + f"""
SELECT wallet_address, {_ts('first_seen')} AS first_seen_ts, historical_tx_count, historical_risk_tier, pagerank,
  community_id, coalesce(in_wash_ring, false) AS in_wash_ring FROM wallets""",
    "tier_counts": GRAPH_WALLETS + """
SELECT historical_risk_tier, count(*) AS n, count(*) FILTER (in_wash_ring) AS n_in_ring FROM wallets GROUP BY 1""",
    "graph_summary": GRAPH_WALLETS + """
SELECT count(*) AS wallet_count,
  (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
    AS edge_count,
  count(*) FILTER (in_wash_ring) AS ring_wallet_count, count(DISTINCT community_id) AS community_count FROM wallets""",
    "draw_nodes": GRAPH_WALLETS + """,
everyone AS (
  SELECT wallet_address FROM top UNION SELECT unnest([wallet_address, to_wallet]) FROM newest)
SELECT wallet_address,
  substr(wallet_address, 1, 8) || '…' || right(wallet_address, 4) AS label,
  CASE WHEN wallet_address IN (SELECT unnest(wallets) FROM ring_list) THEN 'ring'
    WHEN coalesce(pagerank / m, 0.0) > 0.6 THEN 'hub' ELSE 'normal' END AS node_class,
  round(CASE WHEN pagerank IS NOT NULL THEN 10 + 20 * pagerank / m ELSE 8.0 END, 4) AS size
FROM everyone LEFT JOIN (SELECT wallet_address, pagerank FROM top) USING (wallet_address),
  (SELECT greatest(max(pagerank), 0.0001) AS m FROM top)""",
    "draw_edges": GRAPH_WALLETS + f"""
SELECT wallet_address AS from_wallet, to_wallet, {_ts('last_seen')} AS timestamp, {_r('total', 'amount_usd', 2)},
  CASE WHEN rule_reason IS NULL THEN 'normal' ELSE 'flagged' END AS edge_class,
  CASE WHEN rule_reason IS NULL THEN 1 ELSE 2 END AS width FROM newest""",
    "graph_risk": _with_recursive(LOTS, RINGS, FLAGS, _pagerank(PAGERANK_ROUNDS), """
t AS (
  SELECT node, pagerank, coalesce(k, 0)::double AS b, in_wash_ring FROM ranks JOIN flags USING (node)
  LEFT JOIN (SELECT s AS node, count(*) AS k FROM e GROUP BY 1) USING (node)),
x AS (SELECT min(pagerank) AS p0, max(pagerank) AS p1, min(b) AS b0, max(b) AS b1 FROM t)""") + """
SELECT node, round(least(1.0, 0.4 * (pagerank - p0) / (p1 - p0) + 0.3 * (b - b0) / (b1 - b0)
  + CASE WHEN in_wash_ring THEN 0.3 ELSE 0.0 END), 6) AS graph_risk_score FROM t, x""",
    "betweenness": _with(LOTS, _betweenness(24)) + " SELECT node, round(betweenness, 4) AS betweenness FROM central",
    "betweenness_bound": _with(LOTS, _betweenness(24)) + " SELECT node, round(betweenness, 4) AS betweenness, true AS within FROM central",
    "pagerank_updated": _with(LOTS, _pagerank(45, SETTLED_DAMPING)) + " SELECT node, round(pagerank, 4) AS pagerank FROM ranks",
    "rings_updated": _with_recursive(LOTS, RINGS) + f" SELECT {_RING_COLS} FROM rings",
    "refreshed_context": _with_recursive(
        LOTS, RINGS, FLAGS, _pagerank(20), _profiles("cu"), _betweenness(24), _fastrp()) + "," + REFRESHED,
    "fastrp": _with(LOTS, _fastrp()) + " SELECT node, " + ", ".join(_r(f"e{i}", f"e{i}") for i in range(8)) + " FROM embedded",
    "louvain_faults": _with(LOTS) + """
SELECT count(*) AS n_wallets, 0::bigint AS n_gaining, 0::bigint AS n_split, 0::bigint AS n_fallen, true AS matches FROM nodes""",
    "louvain_two_rounds": LOUVAIN + " SELECT node, community FROM g2",
    "modularity": LOUVAIN + """
SELECT round(sum(i) / sum(t) - sum(t * t) / (sum(t) * sum(t)), 6) AS modularity FROM (
  SELECT x.community, sum(CASE WHEN x.community = y.community THEN w ELSE 0 END)::double AS i, sum(w)::double AS t
  FROM sym JOIN g2 x ON x.node = a JOIN g2 y ON y.node = b GROUP BY 1)""",
    "confusion": _with(CELLS, MATRIX) + " SELECT * FROM matrix",
    "detector_report": _with(CELLS, REPORT) + _REPORT_OUT,
    "latest_labelled": f"""{WIN}
SELECT window_start, wallet_address, to_wallet, true_label, (true_label <> 'normal')::int AS y_true,
  (rule_reason IS NOT NULL)::int AS y_rule, 0 AS y_ml, (rule_reason IS NOT NULL)::int AS y_combined
FROM win_judged WHERE true_label IS NOT NULL {_NEWEST} LIMIT 2000""",
    "window_report": _with(WINDOW_CELLS, REPORT) + _REPORT_OUT,
    "window_report_scored": SCORED + "," + SCORED_CELLS + "," + REPORT + _REPORT_OUT,
    "report_written": _with(WINDOW_CELLS, REPORT) + _REPORT_OUT + """
UNION ALL SELECT 'truth', true_label, 'count', count(*)::double FROM win GROUP BY 2""",
    "floor_amounts": "SELECT 'tx' || event_id AS tx_id, greatest(value, 100.0) AS amount_usd FROM events",
    "default_times": """
SELECT 'tx' || event_id AS tx_id, CASE WHEN event_id % 3 = 0 THEN 'now' ELSE left(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 23) END AS timestamp
FROM events""",
    "transfer_report": SCORED + "," + TRANSFER_CELLS + "," + REPORT + _REPORT_OUT,
    "label_counts": f"{WIN} SELECT true_label, count(*) AS n FROM win GROUP BY 1",
}
