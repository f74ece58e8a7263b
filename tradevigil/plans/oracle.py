"""The registered queries as plain SQL over the sample tables, for a second engine.

Each value is one statement. Definitions are chained as common table expressions; only
those a query needs are put in front of it. They state the meaning in the direct way
(self joins, range joins, windows), not the way the operators compute it.
"""

from __future__ import annotations

import re

from tradevigil.sources.sample import FEED_SQL, feed_cte

RATING = "CASE upper({0}) WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END"

DEFINITIONS: dict[str, str] = {name: feed_cte(name) for name in FEED_SQL}

DEFINITIONS |= {
    "feature_trade_base": """
SELECT t.* REPLACE (CAST(t.notional AS DECIMAL(20,2)) AS notional, CAST(t.quantity AS DECIMAL(20,4)) AS quantity,
         CAST(t.price AS DECIMAL(20,4)) AS price, CAST(t.dividend_rate AS DECIMAL(18,6)) AS dividend_rate,
         CAST(t.financing_spread AS DECIMAL(18,6)) AS financing_spread),
       t.notional AS notional1, country, risk_rating, instrument_id, sector,
       CAST(coalesce(upper(risk_flag) = 'INSIDER', false) AS INTEGER) AS label_insider
FROM trades_raw t LEFT JOIN clients_raw USING (client_id) LEFT JOIN instruments_raw USING (underlying, isin)""",
    "base_latest": """
SELECT b.* REPLACE (c.country AS country, c.risk_rating AS risk_rating) FROM feature_trade_base b
LEFT JOIN (SELECT client_id, arg_max(country, sent) AS country, arg_max(risk_rating, sent) AS risk_rating FROM client_sends GROUP BY client_id) c USING (client_id)""",
    "base_as_of": """
SELECT b.* REPLACE (c.country AS country, c.risk_rating AS risk_rating) FROM feature_trade_base b
LEFT JOIN (SELECT *, lead(sent) OVER w AS until, row_number() OVER w AS nth FROM client_sends WINDOW w AS (PARTITION BY client_id ORDER BY sent)) c
  ON c.client_id = b.client_id AND (trade_date >= sent OR nth = 1) AND (until IS NULL OR trade_date < until)""",
    "client_hop1": """
SELECT client_id, count(o.from_client) AS out_degree,
       (SELECT count(*) FROM relationships_raw i WHERE i.to_client = c.client_id) AS in_degree,
       count(DISTINCT o.to_client) AS distinct_neighbors_1hop,
       CAST(count(o.to_client) > 0 AS INTEGER) AS has_1hop_link
FROM clients_raw c LEFT JOIN relationships_raw o ON o.from_client = c.client_id GROUP BY client_id""",
    "hop3_walks": """
SELECT x.from_client AS root_client, x.to_client AS hop1_client, y.to_client AS hop2_client, z.to_client AS hop3_client,
       CAST(z.to_client = x.from_client AS INTEGER) AS is_three_hop_loop
FROM relationships_raw x JOIN relationships_raw y ON y.from_client = x.to_client
JOIN relationships_raw z ON z.from_client = y.to_client""",
    "client_hop3": """
SELECT client_id, count(root_client) AS hop3_path_count,
       CAST(coalesce(sum(is_three_hop_loop), 0) AS BIGINT) AS three_hop_loop_count,
       coalesce(max(is_three_hop_loop), 0) AS in_three_hop_loop
FROM clients_raw LEFT JOIN hop3_walks ON root_client = client_id GROUP BY client_id""",
    "event_proximity": """
SELECT trade_id, CAST(coalesce(min(gap), 9999) AS INTEGER) AS days_to_next_event,
       CAST(coalesce(bool_or(gap <= 7), false) AS INTEGER) AS event_within_7d,
       CAST(coalesce(bool_or(gap <= 3), false) AS INTEGER) AS event_within_3d,
       CAST(coalesce(bool_or(upper(importance) = 'HIGH'), false) AS INTEGER) AS has_high_importance_event,
       CAST(coalesce(bool_or(upper(event_type) LIKE '%EARNING%'), false) AS INTEGER) AS has_earnings_event
FROM trades_raw LEFT JOIN (
  SELECT trade_id, date_diff('day', trade_date, event_date) AS gap, importance, event_type
  FROM trades_raw JOIN events_raw USING (underlying) WHERE date_diff('day', trade_date, event_date) BETWEEN 0 AND 30
) ahead USING (trade_id) GROUP BY trade_id""",
    "feature_store": f"""
SELECT b.*, h.* EXCLUDE (client_id), l.* EXCLUDE (client_id), p.* EXCLUDE (trade_id),
       {RATING.format('jurisdiction_risk')} AS jurisdiction_risk_score, {RATING.format('risk_rating')} AS kyc_risk_score,
       CAST(notional >= 1000000000 AS INTEGER) AS notional_ge_1bn, CAST(notional >= 500000000 AS INTEGER) AS notional_ge_500m
FROM feature_trade_base b LEFT JOIN client_hop1 h USING (client_id) LEFT JOIN client_hop3 l USING (client_id)
LEFT JOIN event_proximity p USING (trade_id)""",
    "feature_store_csv": """
SELECT f.* EXCLUDE (notional, notional1, quantity, price, dividend_rate, financing_spread),
       t.notional, t.quantity, t.price, t.dividend_rate, t.financing_spread
FROM feature_store f JOIN trades_raw t USING (trade_id)""",
    "investigation_view": """
SELECT trade_id, trade_date, client_id, client_name, underlying, notional, notional1, jurisdiction_risk, risk_rating,
       days_to_next_event, has_1hop_link, in_three_hop_loop, event_within_7d, label_insider, 0 AS label_other,
       25 * notional_ge_1bn + 20 * (event_within_7d + in_three_hop_loop) + 15 * has_1hop_link
         + 5 * (jurisdiction_risk_score + kyc_risk_score) AS heuristic_surveillance_score
FROM feature_store""",
    "iq_trades": """
SELECT trade_id, client_id, underlying, trade_date, direction, notional, notional1,
       CAST(notional AS FLOAT) / avg(CAST(notional AS FLOAT)) OVER client AS notional_vs_avg,
       CAST(count(*) OVER (PARTITION BY client_id, underlying) = 1 AS INTEGER) AS new_exposure_flag,
       CAST(notional > 200000000 AS INTEGER) AS large_trade_flag,
       count(*) OVER (PARTITION BY client_id ORDER BY trade_date, trade_id ROWS 7 PRECEDING) AS rolling_frequency,
       label_insider AS is_insider, days_to_next_event, event_within_7d, event_within_3d, jurisdiction_risk,
       jurisdiction_risk_score, risk_rating, kyc_risk_score, notional_ge_1bn, notional_ge_500m,
       CAST(days_to_next_event <= 2 AS INTEGER) + CAST(notional1 > 200000000 AS INTEGER) + jurisdiction_risk_score AS anomaly_score
FROM feature_store WINDOW client AS (PARTITION BY client_id)""",
    "iq_events": """
SELECT p.trade_id, e.event_id, e.underlying, e.event_type, e.event_date, p.days_to_next_event, p.event_within_7d,
       p.event_within_3d, p.has_high_importance_event, p.has_earnings_event
FROM events_raw e LEFT JOIN (feature_trade_base b JOIN event_proximity p ON p.trade_id = b.trade_id)
  ON b.underlying = e.underlying""",
    "client_network": """
SELECT DISTINCT from_client AS root_client, to_client AS connected_client, relationship, t.trade_id, t.underlying, trade_date,
       notional, kyc_risk_score, event_date, event_type, days_to_next_event
FROM relationships_raw JOIN iq_trades t ON t.client_id = to_client
LEFT JOIN (SELECT DISTINCT underlying, event_date, event_type FROM events_raw) e ON e.underlying = t.underlying""",
    "iq_clients": """
SELECT DISTINCT c.client_id, n.to_client AS connected_client, n.relationship, t.trade_id
FROM clients_raw c
LEFT JOIN (SELECT * FROM relationships_raw WHERE to_client IN (SELECT client_id FROM iq_trades)) n ON n.from_client = c.client_id
LEFT JOIN iq_trades t ON t.client_id = c.client_id""",
    "iq_instruments": "SELECT DISTINCT underlying, isin, sector, instrument_id FROM instruments_raw",
    "links": """
SELECT DISTINCT from_client AS src, to_client AS dst, relationship FROM relationships_raw
WHERE from_client IN (SELECT client_id FROM clients_raw) AND to_client IN (SELECT client_id FROM clients_raw)""",
    "walks": """
SELECT src AS root, dst AS peer, 1 AS hops, concat(src, ' -[', relationship, ']-> ', dst) AS chain FROM links
UNION ALL
SELECT a.src, b.dst, 2, concat(a.src, ' -[', a.relationship, ']-> ', b.src, ' -[', b.relationship, ']-> ', b.dst)
FROM links a JOIN links b ON b.src = a.dst
UNION ALL
SELECT a.src, c.dst, 3, concat(a.src, ' -[', a.relationship, ']-> ', b.src, ' -[', b.relationship, ']-> ', c.src, ' -[', c.relationship, ']-> ', c.dst)
FROM links a JOIN links b ON b.src = a.dst JOIN links c ON c.src = b.dst""",
    "reach": "SELECT root, peer, min(hops) AS hops, count(*) AS walks, min_by(chain, (hops, chain)) AS chain FROM walks GROUP BY root, peer",
    "near_trades": """
SELECT * FROM iq_trades WHERE days_to_next_event <= 2 AND underlying IN (SELECT underlying FROM instruments_raw)""",
    "event_clusters": """
SELECT root AS root_client, underlying, count(DISTINCT peer) AS connected_clients,
       CAST(sum(CAST(notional1 AS DECIMAL(30,2))) AS DOUBLE) AS total_exposure, min(days_to_next_event) AS min_days_to_event
FROM reach JOIN near_trades ON client_id = peer GROUP BY root, underlying""",
    "event_clusters_by_walk": """
SELECT root AS root_client, underlying, count(DISTINCT peer) AS connected_clients,
       CAST(sum(CAST(notional1 AS DECIMAL(30,2))) AS DOUBLE) AS total_exposure, min(days_to_next_event) AS min_days_to_event
FROM walks JOIN near_trades ON client_id = peer GROUP BY root, underlying""",
    "scored": """
SELECT trade_id, label_insider, heuristic_surveillance_score / 110.0::DOUBLE AS predicted_probability,
       CAST(heuristic_surveillance_score > 55 AS INTEGER) AS predicted_label
FROM investigation_view""",
    "matrix": "SELECT label_insider AS actual, predicted_label AS predicted, count(*) AS n_rows FROM scored GROUP BY ALL",
    "per_class": """
SELECT class, coalesce(hits / nullif(claimed, 0), 0) AS precision, coalesce(hits / nullif(support, 0), 0) AS recall,
       coalesce(2 * hits / nullif(claimed + support, 0), 0) AS f1, support, hits
FROM (SELECT unnest([0, 1]) AS class), LATERAL (SELECT CAST(coalesce(sum(n_rows) FILTER (WHERE actual = class), 0) AS BIGINT) AS support,
   CAST(coalesce(sum(n_rows) FILTER (WHERE predicted = class), 0) AS BIGINT) AS claimed,
   CAST(coalesce(sum(n_rows) FILTER (WHERE predicted = class AND actual = class), 0) AS BIGINT) AS hits FROM matrix)""",
}

# How decimals and days are handed out: as doubles and as text, alike in all engines.
_MONEY = "notional"
_AMOUNTS = ("notional", "quantity", "price", "dividend_rate", "financing_spread")


def _plain(source: str, money: tuple[str, ...] = (), days: tuple[str, ...] = ()) -> str:
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in money] + [f"CAST({c} AS VARCHAR) AS {c}" for c in days]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM {source}" if casts else f"SELECT * FROM {source}"


_TRADE_DAYS = ("trade_date", "booking_date", "maturity_date")
_NODE = "SELECT {cols} FROM {source} WHERE {key} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {rest}) = 1"

TRADE_NODE_COLUMNS = """trade_id AS id, anomaly_score AS "anomalyScore", client_id AS "clientId", days_to_next_event AS "daysToNextEvent",
 direction, event_within_3d AS "eventWithin3d", event_within_7d AS "eventWithin7d", is_insider AS "isInsider",
 jurisdiction_risk AS "jurisdictionRisk", jurisdiction_risk_score AS "jurisdictionRiskScore", kyc_risk_score AS "kycRiskScore",
 large_trade_flag AS "largeTradeFlag", new_exposure_flag AS "newExposureFlag", CAST(notional AS DOUBLE) AS notional,
 notional_ge_1bn AS "notionalGe1bn", notional_ge_500m AS "notionalGe500m", notional_vs_avg AS "notionalVsAvg", notional1,
 risk_rating AS "riskRating", rolling_frequency AS "rollingFrequency", CAST(trade_date AS VARCHAR) AS "tradeDate", underlying"""

REASONS = """
SELECT trade_id, client_id, underlying, concat_ws('; ',
  CASE WHEN days_to_next_event <= 2 THEN concat('traded ', days_to_next_event, ' days before an event') END,
  CASE WHEN has_high_importance_event = 1 THEN 'high importance event ahead' END,
  CASE WHEN has_earnings_event = 1 THEN 'earnings event ahead' END,
  CASE WHEN notional1 > 500000000 THEN 'exposure above 500,000,000' WHEN notional1 > 200000000 THEN 'exposure above 200,000,000' END,
  CASE WHEN jurisdiction_risk_score = 3 THEN 'high jurisdiction risk' END,
  CASE WHEN kyc_risk_score = 3 THEN 'high client risk rating' END,
  CASE WHEN distinct_neighbors_1hop >= 1 THEN concat('linked to ', distinct_neighbors_1hop, ' clients') END,
  CASE WHEN in_three_hop_loop = 1 THEN 'part of a three-link client loop' END) AS reasons
FROM feature_store"""

_LOADED = _plain("trades_raw", days=_TRADE_DAYS)

# name of the query -> final statement over the definitions
FINAL: dict[str, str] = {
    "feature_trade_base": _plain("feature_trade_base", _AMOUNTS, _TRADE_DAYS),
    "feature_trade_base_incremental": _plain("feature_trade_base", _AMOUNTS, _TRADE_DAYS),
    "feature_trade_base_latest": _plain("base_latest", _AMOUNTS, _TRADE_DAYS),
    "feature_trade_base_as_of": _plain("base_as_of", _AMOUNTS, _TRADE_DAYS),
    "client_hop1": _plain("client_hop1"),
    "client_hop3": _plain("client_hop3"),
    "hop3_walks": _plain("hop3_walks"),
    "event_proximity": _plain("event_proximity"),
    "feature_store": _plain("feature_store", _AMOUNTS, _TRADE_DAYS),
    "feature_store_csv": _plain("feature_store_csv", (), _TRADE_DAYS),
    "investigation_view": _plain("investigation_view", (_MONEY,), ("trade_date",)),
    "iq_trades": _plain("iq_trades", (_MONEY,), ("trade_date",)),
    "iq_trades_incremental": _plain(
        "(SELECT * FROM iq_trades WHERE direction = 'SELL')", (_MONEY,), ("trade_date",)
    ),
    "iq_trades_batch_scope": _plain(
        "(SELECT trade_id, client_id, underlying, trade_date, direction, notional, notional1, "
        "CAST(notional AS FLOAT) / avg(CAST(notional AS FLOAT)) OVER (PARTITION BY client_id) AS notional_vs_avg, "
        "CAST(count(*) OVER (PARTITION BY client_id, underlying) = 1 AS INTEGER) AS new_exposure_flag, large_trade_flag, "
        "count(*) OVER (PARTITION BY client_id ORDER BY trade_date, trade_id ROWS 7 PRECEDING) AS rolling_frequency, "
        "* EXCLUDE (trade_id, client_id, underlying, trade_date, direction, notional, notional1, notional_vs_avg, "
        "new_exposure_flag, large_trade_flag, rolling_frequency) FROM iq_trades WHERE direction = 'SELL')",
        (_MONEY,),
        ("trade_date",),
    ),
    "iq_trades_by_state": _plain("(SELECT * FROM iq_trades WHERE direction = 'SELL')", (_MONEY,), ("trade_date",)),
    "client_trade_state": """
SELECT client_id, underlying, count(*) AS pair_trades, sum(CAST(CAST(notional AS FLOAT) AS DOUBLE)) AS pair_sum, count(notional) AS pair_amounts
FROM feature_store GROUP BY client_id, underlying""",
    "iq_events_grown": """
SELECT event_id, count(*) AS n_rows, count(trade_id) AS trades, min(trade_id) AS first_trade, max(trade_id) AS last_trade,
       CAST(sum(days_to_next_event) AS BIGINT) AS days_sum
FROM iq_events LEFT JOIN (SELECT trade_id, direction FROM trades_raw) USING (trade_id)
WHERE event_type = 'Earnings Release' OR direction = 'SELL' GROUP BY event_id""",
    "iq_clients_grown": """
SELECT * FROM iq_clients EXCEPT
SELECT DISTINCT c.client_id, n.to_client, n.relationship, t.trade_id
FROM (SELECT * FROM clients_raw WHERE client_id NOT LIKE '%7') c
LEFT JOIN (SELECT * FROM relationships_raw WHERE relationship = 'FAMILY'
  AND to_client IN (SELECT client_id FROM iq_trades WHERE direction <> 'SELL')) n ON n.from_client = c.client_id
LEFT JOIN (SELECT * FROM iq_trades WHERE direction <> 'SELL') t ON t.client_id = c.client_id""",
    "iq_events_by_event": """
SELECT event_id, underlying, event_type, CAST(event_date AS VARCHAR) AS event_date, count(*) AS n_rows, count(trade_id) AS trades,
       min(trade_id) AS first_trade, max(trade_id) AS last_trade, CAST(sum(days_to_next_event) AS BIGINT) AS days_sum,
       CAST(sum(event_within_7d) AS BIGINT) AS within_7d, CAST(sum(event_within_3d) AS BIGINT) AS within_3d,
       CAST(sum(has_high_importance_event) AS BIGINT) AS high_importance, CAST(sum(has_earnings_event) AS BIGINT) AS earnings
FROM iq_events GROUP BY ALL""",
    "iq_events_incremental": """
SELECT event_id, count(*) AS n_rows, count(trade_id) AS trades, min(trade_id) AS first_trade, max(trade_id) AS last_trade
FROM iq_events WHERE event_type = 'Earnings Release' GROUP BY event_id""",
    "client_network_by_link": """
SELECT root_client, connected_client, relationship, underlying, count(*) AS n_rows, count(DISTINCT trade_id) AS trades,
       CAST(sum(notional) AS DOUBLE) AS notional_sum, CAST(sum(kyc_risk_score) AS BIGINT) AS kyc_sum,
       CAST(sum(days_to_next_event) AS BIGINT) AS days_sum, CAST(min(trade_date) AS VARCHAR) AS first_trade_date,
       CAST(min(event_date) AS VARCHAR) AS first_event_date, CAST(max(event_date) AS VARCHAR) AS last_event_date,
       max(event_type) AS last_event_type
FROM client_network GROUP BY ALL""",
    "iq_clients": _plain("iq_clients"),
    "iq_instruments": _plain("iq_instruments"),
    "agent_alerts": """
SELECT trade_id, client_id, underlying, risk_flag, heuristic_surveillance_score / 110.0::DOUBLE AS risk_score
FROM investigation_view JOIN (SELECT trade_id, risk_flag FROM trades_raw) USING (trade_id)
WHERE heuristic_surveillance_score / 110.0::DOUBLE > 0.8::DOUBLE""",
    "correct_isin": """
SELECT * REPLACE (CASE underlying WHEN 'Brand#1' THEN 'FIXED-1' WHEN 'Brand#2' THEN 'FIXED-2' ELSE isin END AS isin)
FROM instruments_raw""",
    "graph_nodes_trade": f"SELECT {TRADE_NODE_COLUMNS} FROM iq_trades",
    "graph_nodes_client": _NODE.format(
        cols='client_id AS id, connected_client AS "connectedClient", relationship, trade_id AS "tradeId"',
        source="iq_clients",
        key="client_id",
        rest="connected_client NULLS FIRST, relationship NULLS FIRST, trade_id NULLS FIRST",
    ),
    "graph_nodes_instrument": _NODE.format(
        cols='underlying AS id, instrument_id AS "instrumentId", isin, sector',
        source="instruments_raw",
        key="underlying",
        rest="instrument_id, isin, sector",
    ),
    "graph_nodes_event": 'SELECT event_id AS "eventId", CAST(event_date AS VARCHAR) AS "eventDate", event_type AS "eventType", importance, underlying FROM events_raw',
    "graph_edges_connected_to": _plain("links"),
    "graph_edges_executes": "SELECT client_id AS src, trade_id AS dst FROM iq_trades WHERE client_id IN (SELECT client_id FROM clients_raw)",
    "graph_edges_references": "SELECT trade_id AS src, underlying AS dst FROM iq_trades WHERE underlying IN (SELECT underlying FROM instruments_raw)",
    "graph_edges_has_event": "SELECT underlying AS src, event_id AS dst FROM events_raw WHERE underlying IN (SELECT underlying FROM instruments_raw)",
    "entity_trade": _plain("iq_trades", (_MONEY,), ("trade_date",)),
    "entity_client": _plain("iq_clients"),
    "entity_instrument": _plain("iq_instruments"),
    "entity_event_by_event": """
SELECT event_id, count(*) AS n_rows, min(trade_id) AS first_trade, CAST(sum(days_to_next_event) AS BIGINT) AS days_sum
FROM iq_events GROUP BY event_id""",
    "entity_repeated_keys": """
SELECT client_id, count(*) AS n_rows FROM iq_clients GROUP BY client_id HAVING count(*) > 1""",
    "trade_nodes_by_prefix": f"SELECT {TRADE_NODE_COLUMNS} FROM iq_trades WHERE starts_with(trade_id, 'SWP')",
    "reachable_1_3": "SELECT root, peer, hops FROM reach",
    "reachable_walks": "SELECT root, peer, walks FROM reach",
    "relationship_chain": "SELECT root, peer, hops, chain FROM reach",
    "pre_event_cluster": "SELECT * FROM event_clusters ORDER BY total_exposure DESC, root_client, underlying LIMIT 100",
    "pre_event_cluster_walks": "SELECT * FROM event_clusters_by_walk ORDER BY total_exposure DESC, root_client, underlying LIMIT 100",
    "event_clusters": _plain("event_clusters"),
    "peer_exposure_listing": """
SELECT root AS root_client, peer AS connected_client, notional1 AS exposure, underlying
FROM reach JOIN iq_trades ON client_id = peer WHERE underlying IN (SELECT underlying FROM instruments_raw)""",
    "potential_insider_cluster": """
SELECT *, 'potential insider cluster' AS finding FROM event_clusters WHERE connected_clients >= 2 AND total_exposure > 500000000""",
    "hot_instruments": """
SELECT underlying, CAST(sum(CAST(notional1 AS DECIMAL(30,2))) AS DOUBLE) AS total_exposure, count(*) AS trades, min(days_to_next_event) AS min_days_to_event
FROM iq_trades WHERE days_to_next_event <= 2 GROUP BY underlying HAVING sum(notional) > 500000000""",
    "coordinated_trading": """
SELECT root AS root_client, underlying, count(DISTINCT peer) AS connected_clients, count(*) AS trades,
       CAST(sum(CAST(notional1 AS DECIMAL(30,2))) AS DOUBLE) AS total_exposure, CAST(min(trade_date) AS VARCHAR) AS earliest_trade,
       CAST(max(trade_date) AS VARCHAR) AS latest_trade
FROM reach JOIN iq_trades ON client_id = peer WHERE underlying IN (SELECT underlying FROM instruments_raw)
GROUP BY root, underlying HAVING count(DISTINCT peer) >= 2""",
    "explain_flags": f"SELECT * FROM ({REASONS}) WHERE reasons <> ''",
    "total_exposure": "SELECT CAST(sum(CAST(notional1 AS DECIMAL(30,2))) AS DOUBLE) AS total_exposure FROM iq_trades",
    "avg_risk": "SELECT avg(anomaly_score) AS avg_risk FROM iq_trades",
    "cluster_flag": """
SELECT CASE WHEN sum(notional) > 500000000 AND min(days_to_next_event) <= 2 THEN 'Suspicious Cluster' ELSE 'Normal' END AS cluster_flag
FROM iq_trades""",
    "cluster_flag_by_client": """
SELECT client_id, CASE WHEN sum(notional) > 500000000 AND min(days_to_next_event) <= 2 THEN 'Suspicious Cluster' ELSE 'Normal' END AS cluster_flag
FROM iq_trades GROUP BY client_id""",
    "trade_risk_table": """
SELECT trade_id, client_id, CAST(anomaly_score AS BIGINT) AS sum_anomaly_score,
       CAST(anomaly_score >= lo + 0.5 * (hi - lo) AS INTEGER) AS highlight
FROM iq_trades, (SELECT min(anomaly_score) AS lo, max(anomaly_score) AS hi FROM iq_trades)""",
    "days_to_event_sum": """
SELECT CAST(sum(days_to_next_event) AS BIGINT) AS sum_days_to_next_event FROM event_proximity""",
    "days_to_event_sum_known": """
SELECT CAST(sum(days_to_next_event) AS BIGINT) AS sum_days_to_next_event FROM event_proximity WHERE days_to_next_event < 9999""",
    "network_edges": """
SELECT client_id, connected_client, count(*) AS weight FROM iq_clients WHERE connected_client IS NOT NULL GROUP BY ALL""",
    "exposure_by_from_client": """
SELECT client_id, CAST(sum(CAST(notional1 AS DECIMAL(30,2))) AS DOUBLE) AS total_exposure FROM iq_trades
WHERE client_id IN (SELECT from_client FROM relationships_raw) GROUP BY client_id""",
    "exposure_by_to_client": """
SELECT client_id, CAST(sum(CAST(notional1 AS DECIMAL(30,2))) AS DOUBLE) AS total_exposure FROM iq_trades
WHERE client_id IN (SELECT to_client FROM relationships_raw) GROUP BY client_id""",
    "measures_by_underlying": """
SELECT underlying, jurisdiction_risk, CAST(sum(CAST(notional1 AS DECIMAL(30,2))) AS DOUBLE) AS total_exposure, avg(anomaly_score) AS avg_risk
FROM iq_trades GROUP BY underlying, jurisdiction_risk""",
    "class_balance": """
SELECT label_insider, count(*) AS n_rows, CAST(sum(count(*)) OVER () AS DOUBLE) / count(*) OVER () / count(*) AS weight
FROM feature_store GROUP BY label_insider""",
    "stratified_split": """
SELECT trade_id, label_insider, CAST(row_number() OVER (PARTITION BY label_insider ORDER BY md5(trade_id), trade_id)
    <= n - least(CAST(ceil(n * 0.4) AS BIGINT), n - 1) AS INTEGER) AS is_train
FROM (SELECT trade_id, label_insider, count(*) OVER (PARTITION BY label_insider) AS n FROM feature_store)""",
    "confusion_matrix": _plain("matrix"),
    "classification_report": """
SELECT CAST(class AS VARCHAR) AS class, precision, recall, f1, support FROM per_class
UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support), CAST(sum(support) AS BIGINT) FROM per_class
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per_class
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per_class""",
    "roc_auc": """
SELECT CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
       CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / CAST(2 * sum(pos) * sum(neg) AS DOUBLE) AS roc_auc
FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY predicted_probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM (SELECT predicted_probability, count(*) FILTER (WHERE label_insider = 1) AS pos, count(*) FILTER (WHERE label_insider <> 1) AS neg FROM scored GROUP BY 1))""",
    "ingest_feeds": """
SELECT 'clients' AS feed, client_id AS c1, name AS c2, country AS c3, risk_rating AS c4 FROM clients_raw
UNION ALL SELECT 'events', event_id, underlying, event_type, CAST(event_date AS VARCHAR) FROM events_raw
UNION ALL SELECT 'instruments', instrument_id, underlying, isin, sector FROM instruments_raw
UNION ALL SELECT 'relationships', from_client, to_client, relationship, CAST(NULL AS VARCHAR) FROM relationships_raw
UNION ALL SELECT 'trades', trade_id, client_id, underlying, CAST(trade_date AS VARCHAR) FROM trades_raw""",
    "ingest_incremental": _LOADED,
    "ingest_stream": _LOADED,
    "ingest_stream_features": _plain("iq_trades", (_MONEY,), ("trade_date",)),
    "preview": "SELECT trade_id, client_id, underlying FROM trades_raw ORDER BY trade_id LIMIT 1000",
}


def _needed(statement: str, found: list[str]) -> list[str]:
    for name in DEFINITIONS:
        if name not in found and re.search(rf"\b{name}\b", statement):
            _needed(DEFINITIONS[name], found)
            if name not in found:
                found.append(name)
    return found


def statement(name: str) -> str:
    """The query as one statement with the definitions it needs in front."""
    final = FINAL[name].strip()
    # the links are made once: they are aggregated from all line items and joined several times
    kinds = {"relationships_raw": "AS MATERIALIZED"}
    parts = [f"{n} {kinds.get(n, 'AS')} ({DEFINITIONS[n].strip()})" for n in _needed(final, [])]
    return "WITH " + ",\n".join(parts) + "\n" + final
