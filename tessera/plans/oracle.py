"""DuckDB SQL twins of the catalog queries (the correctness oracle).

Written at row level from the table definitions in ``domain.py`` —
plain joins, no eager aggregation — so they check the Spark plans
independently.  Views ``region nation customer supplier part orders
lineitem events documents ...`` are registered by the runner.
"""

from __future__ import annotations

from tessera.plans.catalog import NAME_WORDS, ORDER_YEARS, REGIONS, SHARE_WORD

USERS = """users_dim AS (
  SELECT c.c_custkey AS id, r.r_name AS user_location
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE c.c_acctbal >= 0)"""

ALL_USERS = USERS.replace("\n  WHERE c.c_acctbal >= 0", "")

SEARCHES = """searches AS (
  SELECT o.o_custkey AS id,
         string_split(p.p_name, ' ') AS genres,
         CAST(year(o.o_orderdate) AS INTEGER) AS year,
         string_split(translate(CASE WHEN l.l_discount >= 0.05
                                     THEN '[''' || p.p_brand || ''']' ELSE '[]' END,
                                '[]''', ''), ', ') AS actors,
         string_split(translate(CASE WHEN l.l_returnflag = 'R'
                                     THEN '[''' || p.p_type || ''']' ELSE '[]' END,
                                '[]''', ''), ', ') AS director
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

TICKETS = """tickets AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS movie_id, l.l_quantity AS n_tickets,
         r.r_name AS city
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def _q(name) -> str:
    return '"' + str(name).replace('"', '""') + '"'


def _lit(value) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["volume_rows_by_location"] = _with(USERS) + """
SELECT u.user_location, COUNT(*) AS n_rows
FROM events e FULL OUTER JOIN users_dim u ON e.user_id = u.id
GROUP BY u.user_location"""

SQL["volume_units_by_location"] = _with(USERS, TICKETS) + """
SELECT u.user_location, COUNT(*) AS n_rows, SUM(t.n_tickets) AS units
FROM tickets t FULL OUTER JOIN users_dim u ON t.user_id = u.id
GROUP BY u.user_location"""

SQL["demand_array_matrix"] = _with(USERS, SEARCHES) + "SELECT u.user_location, " + ", ".join(
    f"CAST(SUM(CAST(list_contains(s.genres, {_lit(w)}) AS INTEGER)) AS BIGINT) AS {_q(w)}"
    for w in NAME_WORDS) + """
FROM searches s FULL OUTER JOIN users_dim u ON s.id = u.id
GROUP BY u.user_location"""

SQL["demand_scalar_matrix"] = _with(USERS, SEARCHES) + "SELECT u.user_location, " + ", ".join(
    f"CAST(SUM(CAST(s.year = {y} AS INTEGER)) AS BIGINT) AS {_q(y)}" for y in ORDER_YEARS) + """
FROM searches s FULL OUTER JOIN users_dim u ON s.id = u.id
GROUP BY u.user_location"""

SQL["demand_measure_matrix"] = _with(USERS, TICKETS) + "SELECT u.user_location, " + ", ".join(
    f"SUM(CASE WHEN t.city = {_lit(r)} THEN t.n_tickets ELSE 0 END) AS {_q(r)}"
    for r in REGIONS) + """
FROM tickets t FULL OUTER JOIN users_dim u ON t.user_id = u.id
GROUP BY u.user_location"""

SQL["demand_event_matrix"] = _with(USERS) + "SELECT u.user_location, " + ", ".join(
    f"CAST(SUM(CAST(e.event_type = {_lit(v)} AS INTEGER)) AS BIGINT) AS {_q(v)}"
    for v in ("click", "error", "purchase", "signup", "view")) + """
FROM events e FULL OUTER JOIN users_dim u ON e.user_id = u.id
GROUP BY u.user_location"""

SQL["demand_array_long"] = _with(USERS, SEARCHES) + """
SELECT u.user_location, v.value, COUNT(*) AS n
FROM (SELECT id, unnest(list_distinct(genres)) AS value FROM searches) v
LEFT JOIN users_dim u ON v.id = u.id
WHERE v.value IS NOT NULL
GROUP BY u.user_location, v.value"""

SQL["demand_macro_average"] = _with(USERS, SEARCHES, "per_loc AS (SELECT u.user_location, " + ", ".join(
    f"AVG(CAST(list_contains(s.genres, {_lit(w)}) AS INTEGER)) AS {_q(w)}" for w in NAME_WORDS) + """
  FROM searches s FULL OUTER JOIN users_dim u ON s.id = u.id
  GROUP BY u.user_location)""") + "SELECT " + ", ".join(
    f"ROUND(AVG({_q(w)}), 6) AS {_q(w)}" for w in NAME_WORDS) + " FROM per_loc"

SQL["domain_array_values"] = _with(USERS, SEARCHES) + """
SELECT DISTINCT value FROM (SELECT unnest(genres) AS value FROM searches)
WHERE value IS NOT NULL AND value <> ''"""

SQL["domain_scalar_values"] = _with(SEARCHES) + """
SELECT DISTINCT year FROM searches WHERE year IS NOT NULL"""

SQL["share_with_value"] = f"""
SELECT ROUND(AVG(COALESCE(CAST(list_contains(string_split(p_name, ' '), {_lit(SHARE_WORD)})
                               AS INTEGER), 0)), 6) AS share
FROM part"""

SQL["presence_rate"] = _with(USERS, SEARCHES) + """
SELECT u.user_location,
       ROUND(AVG(CAST(length(s.actors[1]) > 0 AS INTEGER)), 6) AS has_actors,
       ROUND(AVG(CAST(length(s.director[1]) > 0 AS INTEGER)), 6) AS has_director
FROM searches s FULL OUTER JOIN users_dim u ON s.id = u.id
GROUP BY u.user_location"""

SQL["total_of_group_totals"] = _with(USERS, TICKETS) + """
SELECT SUM(units) AS total_units FROM (
  SELECT u.user_location, SUM(t.n_tickets) AS units
  FROM tickets t FULL OUTER JOIN users_dim u ON t.user_id = u.id
  GROUP BY u.user_location)"""


SQL["user_facts_outer"] = _with(USERS) + """
SELECT e.user_id AS fact_user, e.event_type, u.id, u.user_location
FROM events e FULL OUTER JOIN users_dim u ON e.user_id = u.id"""

# the part table is stored by key
SQL["domain_first_seen"] = """
SELECT value, row_number() OVER (ORDER BY first) - 1 AS place FROM (
  SELECT value, MIN({'k': p_partkey, 'i': i}) AS first FROM (
    SELECT p_partkey, unnest(string_split(p_name, ' ')) AS value,
           generate_subscripts(string_split(p_name, ' '), 1) AS i FROM part) GROUP BY value)"""

_LOCATION_ROWS = """rows_of AS (
  SELECT u.user_location, COUNT(*) AS n_rows, COUNT({f}.{k}) AS n_facts
  FROM {f} FULL OUTER JOIN users_dim u ON {f}.{k} = u.id GROUP BY u.user_location)"""

SQL["demand_sparse_rows"] = _with(USERS, TICKETS, _LOCATION_ROWS.format(f="tickets", k="user_id")) + """
SELECT c.user_location, r.n_rows, c.value, c.n, ROUND(c.n / r.n_facts, 6) AS average FROM (
  SELECT u.user_location, t.movie_id AS value, SUM(t.n_tickets) AS n
  FROM tickets t LEFT JOIN users_dim u ON t.user_id = u.id GROUP BY u.user_location, t.movie_id) c
JOIN rows_of r ON c.user_location IS NOT DISTINCT FROM r.user_location"""

SQL["demand_sparse_counts"] = _with(USERS, SEARCHES, _LOCATION_ROWS.format(f="searches", k="id")) + """
SELECT c.user_location, c.mode, r.n_rows, c.value, c.n, ROUND(c.n / r.n_facts, 6) AS average FROM (
  SELECT u.user_location, 'array' AS mode, v.value, COUNT(*) AS n
  FROM (SELECT id, unnest(list_distinct(genres)) AS value FROM searches) v LEFT JOIN users_dim u ON v.id = u.id
  GROUP BY u.user_location, v.value
  UNION ALL
  SELECT u.user_location, 'scalar', CAST(s.year AS VARCHAR), COUNT(*)
  FROM searches s LEFT JOIN users_dim u ON s.id = u.id GROUP BY u.user_location, s.year) c
JOIN rows_of r ON c.user_location IS NOT DISTINCT FROM r.user_location"""

# --- text ------------------------------------------------------------------

def _after_marker_sql(words: str, marker: str, n: int) -> str:
    return (f"list_filter(list_transform({words}, lambda x, i: CASE WHEN x = {_lit(marker)} "
            f"THEN array_to_string({words}[i + 1:i + {n}], ' ') END), lambda y: y IS NOT NULL)")


for _n in (2, 1):
    SQL[f"words_after_marker_n{_n}"] = f"""
WITH w AS (SELECT doc_id, string_split(regexp_replace(text, '\\W+', ' ', 'g'), ' ') AS ws
           FROM documents),
h AS (SELECT doc_id, {_after_marker_sql('ws', 'the', _n)} AS hits FROM w)
SELECT doc_id, CAST(len(hits) AS BIGINT) AS n_hits, array_to_string(hits, '|') AS hits FROM h"""

SQL["list_literal_roundtrip"] = """
WITH l AS (SELECT p_partkey,
                  string_split(translate('[''' || replace(p_name, ' ', ''', ''') || ''']',
                                         '[]''', ''), ', ') AS items
           FROM part)
SELECT p_partkey, CAST(len(items) AS BIGINT) AS n_items, array_to_string(items, '|') AS items
FROM l"""

# The names that the raw lines hold, straight from their columns (no text is parsed here).
CREDIT_NAMES = """credit_names AS (
  SELECT CAST(p_partkey AS INTEGER) AS id,
         [p_name, CASE WHEN p_partkey % 11 = 0 THEN 'O''Neil ' || p_type
                       WHEN p_partkey % 7 = 0 THEN p_type || ' None' ELSE p_type END] AS actors,
         [p_brand] AS director
  FROM part)"""


def _two_words_sql(names: str, following: str, digits: str) -> str:
    plain = f"regexp_replace(n, {_lit(digits)}, ' ', 'g')" if digits else "n"
    plain = f"regexp_replace({plain}, '\\W+', ' ', 'g')"
    return (f"list_transform({names}, lambda n: array_to_string((list_filter(string_split({plain}, ' '), "
            f"lambda w: w <> '') || [{_lit(following)}])[1:2], ' '))")


CREDITS = f"""credits AS (
  SELECT id, {_two_words_sql('actors', 'order', '[0-9]')} AS actors,
         {_two_words_sql('director', 'profile_path', '')} AS director
  FROM credit_names)"""

SQL["credits_text_parse"] = _with(CREDIT_NAMES, CREDITS) + """
SELECT id, array_to_string(actors, '|') AS actors, array_to_string(director, '|') AS director
FROM credits"""

SQL["date_pattern_year"] = """
SELECT o_orderkey,
       CAST(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS release_date,
       CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders"""

# --- staged curtain aggregates ---------------------------------------------

CURTAIN = """curtain AS (
  SELECT CAST(day(l_shipdate) AS INTEGER) AS day, CAST(month(l_shipdate) AS INTEGER) AS month,
         l_discount AS value, l_returnflag AS face, l_linestatus AS curtain
  FROM lineitem)"""

SQL["two_stage_extremes"] = _with(CURTAIN, """m AS (
  SELECT day, month, curtain, AVG(value) AS mean_value FROM curtain GROUP BY day, month, curtain)""") + """
SELECT month, curtain, ROUND(MAX(mean_value), 7) AS max_mean, ROUND(MIN(mean_value), 7) AS min_mean
FROM m GROUP BY month, curtain"""

SQL["two_stage_extremes_long"] = _with(CURTAIN, """m AS (
  SELECT day, month, curtain, AVG(value) AS mean_value FROM curtain GROUP BY day, month, curtain)""") + """
SELECT month, curtain, 'max' AS kind, ROUND(MAX(mean_value), 7) AS mean_value
FROM m GROUP BY month, curtain
UNION ALL
SELECT month, curtain, 'min' AS kind, ROUND(MIN(mean_value), 7) AS mean_value
FROM m GROUP BY month, curtain"""

# "for all" written as a set difference, independent of the min() form.
SQL["groups_always_above"] = _with(CURTAIN, """m AS (
  SELECT day, month, face, curtain, AVG(value) AS mean_value
  FROM curtain GROUP BY day, month, face, curtain)""", """ok AS (
  SELECT DISTINCT month, face FROM m
  EXCEPT
  SELECT DISTINCT month, face FROM m WHERE mean_value < 0.041)""") + """
SELECT month, array_to_string(list_sort(list(face)), ',') AS faces FROM ok GROUP BY month"""

SQL["groups_mean_rdd_equiv"] = _with(CURTAIN) + """
SELECT day, month, face, curtain, ROUND(AVG(value), 6) AS mean_value
FROM curtain GROUP BY day, month, face, curtain"""

# --- sensor profiles -------------------------------------------------------

SENSOR = """sensor AS (
  SELECT event_id AS "Index", epoch_us(ts) // 1000 AS arrival, epoch_us(ts) AS creation,
         'dev_' || CAST(user_id % 2 + 1 AS VARCHAR) AS device, 'ev' || CAST(user_id % 3 + 1 AS VARCHAR) AS model,
         CAST(user_id AS VARCHAR) AS usr, event_type AS gt, value AS x,
         CAST(json_extract(props, '$.k') AS DOUBLE) AS y,
         value - CAST(json_extract(props, '$.k') AS DOUBLE) AS z,
         CAST(hour(ts) AS INTEGER) AS hr, CAST(minute(ts) AS INTEGER) AS mi
  FROM events)"""

_GT = ("click", "error", "purchase", "signup", "view")

SQL["sensor_hour_minute"] = _with(SENSOR) + """
SELECT "Index", hr AS "Hour", mi AS "Minutes" FROM sensor"""

SQL["class_counts"] = _with(SENSOR) + "SELECT gt, COUNT(*) AS n FROM sensor GROUP BY gt"

SQL["class_shares"] = _with(SENSOR) + """
SELECT gt, COUNT(*) AS n, ROUND(COUNT(*) / (SELECT COUNT(*) FROM sensor), 6) AS share
FROM sensor GROUP BY gt"""

SQL["class_mean_hour"] = _with(SENSOR) + """
SELECT gt, CAST(trunc(AVG(hr)) AS INTEGER) AS "mean_Hour" FROM sensor GROUP BY gt"""

SQL["pivot_mean_hour"] = _with(SENSOR) + 'SELECT usr AS "User", ' + ", ".join(
    f"CAST(trunc(AVG(hr) FILTER (WHERE gt = {_lit(g)})) AS INTEGER) AS {_q(g)}" for g in _GT) + """
FROM sensor GROUP BY usr"""

SQL["pivot_count"] = _with(SENSOR) + 'SELECT usr AS "User", ' + ", ".join(
    f"NULLIF(COUNT(*) FILTER (WHERE gt = {_lit(g)}), 0) AS {_q(g)}" for g in _GT) + """
FROM sensor GROUP BY usr"""

SQL["cross_counts_hour_user"] = _with(SENSOR) + """
SELECT hr AS "Hour", usr AS "User", COUNT(*) AS n FROM sensor GROUP BY hr, usr"""
SQL["cross_counts_hour_class"] = _with(SENSOR) + """
SELECT hr AS "Hour", gt, COUNT(*) AS n FROM sensor GROUP BY hr, gt"""
SQL["cross_counts_class_user"] = _with(SENSOR) + """
SELECT gt, usr AS "User", COUNT(*) AS n FROM sensor GROUP BY gt, usr"""

SQL["class_centroids"] = _with(SENSOR) + """
SELECT gt, ROUND(AVG(x), 6) AS avg_x, ROUND(AVG(y), 6) AS avg_y, ROUND(AVG(z), 6) AS avg_z
FROM sensor GROUP BY gt"""

SQL["axis_density"] = _with(SENSOR) + """
SELECT CAST(floor(x / 5.0) AS BIGINT) AS x_bin, CAST(floor(y / 5.0) AS BIGINT) AS y_bin, gt,
       COUNT(*) AS n
FROM sensor GROUP BY 1, 2, 3"""

SQL["time_span"] = _with(SENSOR) + """
SELECT MIN(creation) AS min_time, MAX(creation) AS max_time,
       ROUND((MAX(creation) - MIN(creation)) / 3600000000.0, 6) AS span_hours
FROM sensor"""

SQL["distinct_models"] = _with(SENSOR) + "SELECT COUNT(DISTINCT model) AS n_models FROM sensor"

SQL["distinct_users_merged"] = """
SELECT event_type, COUNT(DISTINCT user_id) AS n_users FROM events GROUP BY event_type
UNION ALL SELECT 'all', COUNT(DISTINCT user_id) FROM events"""

SQL["distinct_devices"] = _with(SENSOR) + 'SELECT DISTINCT device AS "Device" FROM sensor'

SQL["device_counts"] = _with(SENSOR) + """
SELECT device AS "Device", COUNT(*) AS n FROM sensor GROUP BY device"""


# --- placement -------------------------------------------------------------

MOVIES = """sold AS (
  SELECT l.l_partkey, l.l_quantity, l.l_shipdate, r.r_name
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
part_cities AS (
  SELECT l_partkey, list_sort(list(r_name)) AS cities FROM (
    SELECT l_partkey, r_name, SUM(l_quantity) AS units,
           SUM(SUM(l_quantity)) OVER (PARTITION BY l_partkey) AS whole
    FROM sold GROUP BY l_partkey, r_name) WHERE 4 * units >= whole GROUP BY l_partkey),
part_release AS (
  SELECT l_partkey, l_shipdate AS shipped FROM (
    SELECT l_partkey, l_shipdate,
           row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity DESC, l_shipdate DESC) AS rk
    FROM sold) WHERE rk = 1),
movies AS (
  SELECT p.p_partkey AS id, string_split(p.p_name, ' ') AS genres, c.cities,
         CAST(r.shipped AS DATE) AS release_date, CAST(year(r.shipped) AS INTEGER) AS year
  FROM part p LEFT JOIN part_cities c ON p.p_partkey = c.l_partkey
  LEFT JOIN part_release r ON p.p_partkey = r.l_partkey)"""

_CREDITS_CTES = [CREDIT_NAMES, CREDITS]

BASE = """base AS (
  SELECT m.id, m.genres, m.cities, m.release_date, m.year, c.actors, c.director
  FROM movies m JOIN credits c ON m.id = c.id)"""


def _base_sql(*more: str) -> str:
    return _with(MOVIES, *_CREDITS_CTES, BASE, *more)


def _txt(col: str) -> str:
    return f"array_to_string({col}, '|') AS {col}"


_BASE_COLS = ["id", _txt("genres"), _txt("cities"), "release_date", "year", _txt("actors"),
              _txt("director")]


def _site_where(any_of, min_year=None) -> str:
    cond = "list_has_any(cities, [" + ", ".join(_lit(v) for v in any_of) + "])"
    if min_year is not None:
        cond += f" AND year >= {min_year}"
    return cond


_SITES_SQL = {  # site -> (rows, min_year, dropped columns, split values)
    "north": (("EUROPE", "AMERICA"), 1996, (), ("small",)),
    "center": (("EUROPE", "ASIA"), 1996, ("director",), ("red", "blue")),
    "east": (("ASIA", "MIDDLE EAST"), None, ("director",), ()),
    "south": (("AFRICA",), None, ("director", "actors"), ()),
    "west": (("AFRICA", "AMERICA"), None, ("director",), ("hot", "cold")),
}


def _site_cols(dropped) -> str:
    keep = [c for c in _BASE_COLS if c.split(" AS ")[-1].strip() not in dropped
            and c not in dropped]
    return ", ".join(keep)


SQL["placement_inner_base"] = _base_sql() + "SELECT " + ", ".join(_BASE_COLS) + " FROM base"

for _s, (_rows, _y, _drop, _split) in _SITES_SQL.items():
    SQL[f"fragment_{_s}"] = (_base_sql() + f"SELECT {_site_cols(_drop)} FROM base WHERE "
                             + _site_where(_rows, _y))

_north = _SITES_SQL["north"]
SQL["fragment_part"] = (_base_sql() + f"SELECT {_site_cols(())} FROM base WHERE "
                        + _site_where(_north[0], _north[1])
                        + " AND list_has_any(genres, ['small'])")
SQL["fragment_rest"] = (_base_sql() + f"SELECT {_site_cols(())} FROM base WHERE "
                        + _site_where(_north[0], _north[1])
                        + f" EXCEPT SELECT {_site_cols(())} FROM base WHERE "
                        + _site_where(_north[0], _north[1])
                        + " AND list_has_any(genres, ['small'])")

SQL["derived_fragment_semi"] = _base_sql() + f"""
SELECT c.id, array_to_string(c.actors, '|') AS actors, array_to_string(c.director, '|') AS director
FROM credits c
WHERE c.id IN (SELECT id FROM base WHERE {_site_where(*_SITES_SQL['east'][:2])})"""

_PLACED = "placed AS (" + " UNION ALL ".join(
    f"SELECT id, {_lit(s)} AS site FROM base WHERE {_site_where(r, y)}"
    for s, (r, y, _d, _p) in _SITES_SQL.items()) + ")"

SQL["placement_lost"] = _base_sql(_PLACED) + """
SELECT DISTINCT id FROM movies EXCEPT SELECT DISTINCT id FROM placed"""

SQL["placement_orphan"] = _base_sql(_PLACED) + """
SELECT DISTINCT id FROM placed EXCEPT SELECT doc_id FROM documents"""

SQL["placement_site_counts"] = _base_sql(_PLACED) + """
SELECT site, COUNT(DISTINCT id) AS n_ids FROM placed GROUP BY site"""

def _pieces_sql() -> str:
    parts = []
    for site, (rows, year, drop, split) in _SITES_SQL.items():
        cols = [f"NULL AS {c}" if c in drop else _txt(c) for c in ("genres", "cities")] + [
            "release_date", "year"] + [f"NULL AS {c}" if c in drop else _txt(c) for c in ("actors", "director")]
        head = f"SELECT {_lit(site)} AS site, %s AS piece, id, {', '.join(cols)} FROM base WHERE " + _site_where(rows, year)
        if split:
            own = "list_has_any(genres, [" + ", ".join(_lit(v) for v in split) + "])"
            parts.append(head % "'part'" + f" AND {own}")
            parts.append("SELECT * FROM (" + head % "'rest'" + " EXCEPT " + head % "'rest'" + f" AND {own})")
        else:
            parts.append(head % "'all'")
        if site != "north":
            parts.append(f"SELECT {_lit(site)}, 'details', c.id, NULL, NULL, NULL, NULL, array_to_string(c.actors, '|'), "
                         f"array_to_string(c.director, '|') FROM credits c WHERE c.id IN "
                         f"(SELECT id FROM base WHERE {_site_where(rows, year)})")
    return " UNION ALL ".join(parts)


SQL["placement_written"] = _base_sql() + _pieces_sql()
SQL["placement_manifest"] = _base_sql() + f"SELECT site, piece, COUNT(*) AS n_rows FROM ({_pieces_sql()}) GROUP BY site, piece"

SQL["placement_union_ids"] = _base_sql(_PLACED) + "SELECT id FROM placed"

# --- file round trips ------------------------------------------------------

SQL["csv_roundtrip"] = _with(TICKETS) + """
SELECT CAST(user_id AS INTEGER) AS user_id, CAST(movie_id AS INTEGER) AS movie_id,
       CAST(n_tickets AS INTEGER) AS n_tickets, city
FROM tickets"""

SQL["csv_array_as_text"] = _with(MOVIES) + """
SELECT CAST(id AS VARCHAR) AS id,
       '[' || array_to_string(genres, ', ') || ']' AS genres,
       '[' || array_to_string(cities, ', ') || ']' AS cities
FROM movies"""

SQL["json_scan"] = _with(SENSOR) + """
SELECT arrival AS "Arrival_Time", creation AS "Creation_Time", device AS "Device",
       "Index", model AS "Model", usr AS "User", gt, x, y, z
FROM sensor"""

SQL["tsv_single_column"] = SQL["credits_text_parse"]

SQL["curtain_positional_csv"] = SQL["two_stage_extremes"]


# --- features --------------------------------------------------------------

SQL["string_index"] = _with(SENSOR) + """
SELECT gt, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, gt) - 1 AS DOUBLE) AS gt_index
FROM sensor GROUP BY gt"""

SQL["user_index"] = _with(SENSOR) + """
SELECT usr AS value, COUNT(*) AS n, row_number() OVER (ORDER BY COUNT(*) DESC, usr) - 1 AS user_index
FROM sensor GROUP BY usr"""

SQL["user_index_rows"] = _with(SENSOR, """codes AS (
  SELECT usr, row_number() OVER (ORDER BY COUNT(*) DESC, usr) - 1 AS code FROM sensor GROUP BY usr)""") + """
SELECT "Index", code FROM sensor JOIN codes USING (usr)"""

SQL["value_ranks"] = _with(SENSOR) + """
SELECT "Index", x, rank() OVER (ORDER BY x DESC) AS rank, dense_rank() OVER (ORDER BY x DESC) AS dense_rank
FROM sensor"""

SQL["sorted_positions"] = _with(SENSOR) + """
SELECT "Index", gt, x, row_number() OVER (ORDER BY gt, x DESC, "Index") AS position FROM sensor"""

SQL["sorted_page"] = _with(SENSOR) + """
SELECT "Index", gt, x, 100 + row_number() OVER (ORDER BY gt, x DESC, "Index") AS position FROM (
  SELECT * FROM sensor ORDER BY gt, x DESC, "Index" LIMIT 50 OFFSET 100)"""

SQL["device_suffix"] = _with(SENSOR) + """
SELECT "Index", device AS "Device", TRY_CAST(split_part(device, '_', 2) AS INTEGER) - 1 AS device_code
FROM sensor"""

_GT_VOCAB = ("view", "click", "signup", "error", "purchase")

SQL["code_lookup"] = _with(SENSOR) + 'SELECT "Index", CASE gt ' + " ".join(
    f"WHEN {_lit(g)} THEN {float(i)}" for i, g in enumerate(_GT_VOCAB)) + """ END::DOUBLE AS label,
       CASE device WHEN 'dev_1' THEN 0.0 WHEN 'dev_2' THEN 1.0 END::DOUBLE AS device_index
FROM sensor"""

SQL["user_onehot"] = _with(SENSOR, """codes AS (
  SELECT usr, row_number() OVER (ORDER BY MIN("Index" // 4000), usr) - 1 AS code FROM sensor GROUP BY usr)""") + """
SELECT "Index", code, 1 AS value FROM sensor JOIN codes USING (usr)"""

SQL["decode_json_bytes"] = SQL["json_scan"]

# Majority-class prequential run: block = event_id div 2500, batch 0 is
# scored by a model fitted on itself, batch e >= 1 by the model fitted on
# blocks <= e - 1 (in the wide form <= min(e - 1, 38): retraining stops once epoch + 1 reaches 40).
SQL["prequential_metrics_wide"] = """
WITH ev AS (SELECT event_id // 100000 AS epoch, event_type AS gt FROM events),
cnt AS (SELECT epoch, gt, COUNT(*) AS c FROM ev GROUP BY epoch, gt),
horizon AS (SELECT DISTINCT epoch,
                   CASE WHEN epoch = 0 THEN 0 ELSE LEAST(epoch - 1, 38) END AS upto FROM ev),
seen AS (SELECT h.epoch, c.gt, SUM(c.c) AS c
         FROM horizon h JOIN cnt c ON c.epoch <= h.upto GROUP BY h.epoch, c.gt),
pred AS (SELECT epoch, gt FROM (
           SELECT epoch, gt, row_number() OVER (PARTITION BY epoch ORDER BY c DESC, gt) AS rk
           FROM seen) WHERE rk = 1),
per_epoch AS (SELECT e.epoch, COUNT(*) AS n_rows,
                     CAST(SUM(CASE WHEN e.gt = p.gt THEN 1 ELSE 0 END) AS BIGINT) AS n_correct
              FROM ev e JOIN pred p ON e.epoch = p.epoch GROUP BY e.epoch)
SELECT epoch, n_rows, n_correct,
       CAST(SUM(n_rows) OVER (ORDER BY epoch) AS BIGINT) AS cum_rows,
       CAST(SUM(n_correct) OVER (ORDER BY epoch) AS BIGINT) AS cum_correct
FROM per_epoch"""

SQL["prequential_metrics"] = SQL["prequential_metrics_wide"].replace("// 100000", "// 2500") \
    .replace("LEAST(epoch - 1, 38)", "epoch - 1")

_LANGUAGE = """
SELECT split, CAST(SUM(n) AS BIGINT) AS n_rows, ROUND(MAX(n) / SUM(n), 6) AS majority_share, TRUE AS beats_majority
FROM (SELECT CASE WHEN CAST('0x' || substr(md5('42:' || doc_id), 1, 8) AS BIGINT) % 100 < 70 THEN 'train'
                  ELSE 'test' END AS split, lang, COUNT(*) AS n
      FROM documents WHERE lang IS NOT NULL GROUP BY 1, 2) GROUP BY split"""
SQL["logistic_language"] = SQL["forest_language"] = _LANGUAGE

SQL["prequential_forest"] = """
SELECT epoch, n_rows, CAST(SUM(n_rows) OVER (ORDER BY epoch) AS BIGINT) AS cum_rows, TRUE AS scored
FROM (SELECT event_id // 2500 AS epoch, COUNT(*) AS n_rows FROM events GROUP BY 1)"""

SQL["prequential_tree"] = """
SELECT epoch, n_rows, CAST(SUM(n_rows) OVER (ORDER BY epoch) AS BIGINT) AS cum_rows,
       (SELECT ROUND(MAX(n) / SUM(n), 6) FROM (SELECT COUNT(*) AS n FROM documents
        WHERE lang IS NOT NULL GROUP BY lang)) AS majority_share, TRUE AS beats_majority
FROM (SELECT doc_id // 250 AS epoch, COUNT(*) AS n_rows FROM documents WHERE lang IS NOT NULL GROUP BY 1)"""

# --- generic aggregates ----------------------------------------------------

SQL["numeric_means_by_class"] = _with(SENSOR) + """
SELECT gt, ROUND(AVG(x), 6) AS avg_x, ROUND(AVG(y), 6) AS avg_y, ROUND(AVG(z), 6) AS avg_z,
       ROUND(AVG(hr), 6) AS "avg_Hour", ROUND(AVG(mi), 6) AS "avg_Minutes"
FROM sensor GROUP BY gt"""

SQL["numeric_sums_by_location"] = _with(USERS, TICKETS) + """
SELECT u.user_location, SUM(t.n_tickets) AS sum_n_tickets, CAST(SUM(t.movie_id) AS BIGINT) AS sum_movie_id
FROM tickets t LEFT JOIN users_dim u ON t.user_id = u.id
GROUP BY u.user_location"""

SQL["accounting_totals"] = _with(ALL_USERS, SEARCHES, TICKETS) + """
SELECT (SELECT COUNT(*) FROM searches) AS n_searches, (SELECT COUNT(*) FROM users_dim) AS n_users,
       (SELECT SUM(n_tickets) FROM tickets) AS n_units"""


# --- saved-search matching (brute force: every search against every movie) ---

_SEARCH = _base_sql("""nations AS (
  SELECT l.l_partkey, list(DISTINCT n.n_name) AS countries
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY l.l_partkey)""", """m AS (
  SELECT b.*, [p.p_brand || ' Films'] AS prod_comp, coalesce(n.countries, []) AS countries,
         list_transform(coalesce(b.cities, []), lambda c: lower(substr(c, 1, 2))) AS languages
  FROM base b JOIN part p ON b.id = p.p_partkey LEFT JOIN nations n ON b.id = n.l_partkey)""", """s AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS search_id, string_split(p.p_name, ' ') AS genres,
         CASE WHEN l.l_returnflag = 'A' THEN [p.p_name] ELSE [] END AS actors,
         CASE WHEN l.l_returnflag = 'R' THEN [replace(p.p_brand, '#', ' ')] ELSE [] END AS director,
         CASE WHEN l.l_returnflag = 'N' THEN [p.p_brand || ' Films'] ELSE [] END AS company,
         CASE WHEN l.l_linestatus = 'O' THEN [r.r_name] ELSE [] END AS cities,
         CASE WHEN l.l_linestatus = 'F' THEN [n.n_name, hn.n_name] ELSE [] END AS country,
         CASE WHEN l.l_discount >= 0.05 THEN [lower(substr(r.r_name, 1, 2))] ELSE [] END AS lang,
         CAST(year(o.o_orderdate) AS INTEGER) - 4 AS date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier su ON l.l_suppkey = su.s_suppkey
  JOIN nation n ON su.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation hn ON c.c_nationkey = hn.n_nationkey)""", """keyed AS (
  SELECT search_id, to_json([genres, actors, director, company, cities, country, lang, [CAST(date AS VARCHAR)]]) AS k,
         genres, actors, director, company, cities, country, lang, date FROM s)""", """sets AS (
  SELECT k, any_value(genres) AS genres, any_value(actors) AS actors, any_value(director) AS director,
         any_value(company) AS company, any_value(cities) AS cities, any_value(country) AS country,
         any_value(lang) AS lang, any_value(date) AS date FROM keyed GROUP BY k)""", """hits AS (
  SELECT DISTINCT s.k, m.id
  FROM (SELECT *, unnest(genres) AS word FROM sets) s
  JOIN (SELECT *, unnest(genres) AS word FROM m) m ON s.word = m.word
   AND m.year >= s.date
   AND list_has_all(coalesce(m.actors, []), s.actors)
   AND list_has_all(coalesce(m.director, []), s.director)
   AND (len(s.company) = 0 OR list_has_any(m.prod_comp, s.company))
   AND (len(s.cities) = 0 OR list_has_any(coalesce(m.cities, []), s.cities))
   AND (len(s.country) = 0 OR list_has_any(m.countries, s.country))
   AND (len(s.lang) = 0 OR list_has_any(m.languages, s.lang)))""")
SQL["search_matches"] = _SEARCH + """
SELECT keyed.search_id, coalesce(n.n_matches, 0) AS n_matches
FROM keyed LEFT JOIN (SELECT k, COUNT(*) AS n_matches FROM hits GROUP BY k) n USING (k)"""
SQL["search_pairs"] = _SEARCH + """
SELECT keyed.search_id, hits.id AS movie_id FROM keyed LEFT JOIN hits USING (k)"""


SQL["demand_array_matrix_discovered"] = SQL["demand_array_matrix"]


# --- source-format parsers (same text, parsed by the same rules in SQL) ----

SQL["users_csv_parse"] = _with(ALL_USERS) + """
SELECT CAST(id AS INTEGER) AS id, user_location FROM users_dim"""

_LL = "string_split(translate({t}, '[]''', ''), ', ')"  # list literal -> list


def _ll_text(col: str) -> str:
    return "'[''' || array_to_string(" + col + ", ''', ''') || ''']'"


SQL["searches_csv_parse"] = _with(SEARCHES) + """
SELECT CAST(id AS INTEGER) AS id,
       array_to_string(""" + _LL.format(t=_ll_text("genres")) + """, '|') AS genres,
       'en' AS lang,
       array_to_string(""" + _LL.format(t=_ll_text("actors")) + """, '|') AS actors,
       array_to_string(""" + _LL.format(t=_ll_text("director")) + """, '|') AS director,
       '' AS cities, '' AS country, year AS date, '' AS company
FROM searches"""


def _compat_names(text: str, key: str, squeeze: bool) -> str:
    t = f"regexp_replace({text}, ' ', '', 'g')" if squeeze else text
    words = f"string_split(regexp_replace({t}, '\\W+', ' ', 'g'), ' ')"
    return ("array_to_string(list_filter(list_transform(" + words + ", lambda x, i: CASE WHEN x = "
            + _lit(key) + " THEN array_to_string((" + words + ")[i + 1:i + 1], ' ') END), "
            "lambda y: y IS NOT NULL), '|')")


SQL["movies_csv_parse"] = _with(MOVIES, """raw AS (
  SELECT m.id,
         '[' || array_to_string(list_transform(m.genres, lambda w, i:
                '{''id'': ' || i || ', ''name'': ''' || w || '''}'), ', ') || ']' AS genres,
         '[{''name'': ''' || p.p_brand || ' Films'', ''id'': 3}]' AS companies,
         '[' || array_to_string(list_transform(coalesce(m.cities, []), lambda c:
                '{''iso_3166_1'': ''XX'', ''name'': ''' || c || '''}'), ', ') || ']' AS countries,
         '[' || array_to_string(list_transform(coalesce(m.cities, []), lambda c:
                '{''iso_639_1'': ''' || lower(substr(c, 1, 2)) || ''', ''name'': ''' || c
                || '''}'), ', ') || ']' AS languages,
         coalesce(m.cities, []) AS cities, m.release_date
  FROM movies m JOIN part p ON m.id = p.p_partkey)""") + """
SELECT CAST(id AS INTEGER) AS id,
       """ + _compat_names("genres", "name", False) + """ AS genres,
       """ + _compat_names("companies", "name", True) + """ AS prod_comp,
       """ + _compat_names("countries", "name", True) + """ AS countries,
       release_date,
       """ + _compat_names("languages", "iso_639_1", False) + """ AS languages,
       array_to_string(cities, '|') AS cities
FROM raw"""


def _clean_names(text: str, key: str) -> str:
    return ("array_to_string(regexp_extract_all(" + text + ", '''" + key
            + "'': ''([^'']*)''', 1), '|')")


SQL["movies_csv_parse_clean"] = SQL["movies_csv_parse"].split("\nSELECT CAST(id AS INTEGER)")[0] + """
SELECT CAST(id AS INTEGER) AS id,
       """ + _clean_names("genres", "name") + """ AS genres,
       """ + _clean_names("companies", "name") + """ AS prod_comp,
       """ + _clean_names("countries", "name") + """ AS countries,
       release_date,
       """ + _clean_names("languages", "iso_639_1") + """ AS languages,
       array_to_string(cities, '|') AS cities
FROM raw"""


# --- split and assembled features (md5 split is reproducible in SQL) -------

_SPLIT = """split AS (
  SELECT *, CAST(('0x' || substr(md5('42:' || CAST("Index" AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 70
            AS is_train
  FROM sensor)"""

SQL["hash_split_counts"] = _with(SENSOR, _SPLIT) + """
SELECT CASE WHEN is_train THEN 'train' ELSE 'test' END AS split, COUNT(*) AS n
FROM split GROUP BY 1"""

# label = frequency rank of the class among training rows (ties by name);
# vector width per one-hot column = distinct training values + the
# indexer's unseen bucket + the encoder's invalid slot - the dropped last
# slot, i.e. distinct + 1; plus x, y, z.
SQL["onehot_assemble"] = _with(SENSOR, _SPLIT, """lab AS (
  SELECT gt, row_number() OVER (ORDER BY COUNT(*) DESC, gt) - 1 AS idx
  FROM split WHERE is_train GROUP BY gt)""", """width AS (
  SELECT (COUNT(DISTINCT usr) + 1)
         + (COUNT(DISTINCT CAST(split_part(device, '_', 2) AS INTEGER) - 1) + 1)
         + (COUNT(DISTINCT hr) + 1) + (COUNT(DISTINCT mi) + 1) + 3 AS n
  FROM split WHERE is_train)""") + """
SELECT s."Index", CAST(coalesce(l.idx, (SELECT COUNT(*) FROM lab)) AS DOUBLE) AS label,
       CAST((SELECT n FROM width) AS INTEGER) AS n_features
FROM split s LEFT JOIN lab l ON s.gt = l.gt"""

# places: users first, then devices, hours and minutes, each by frequency
# among training rows (ties by text), values not seen there in one place more.
_PLACED = (("u", "usr"), ("d", "CAST(split_part(device, '_', 2) AS INTEGER) - 1"), ("h", "hr"), ("m", "mi"))
_CODES = [f"""{a} AS (
  SELECT CAST({e} AS VARCHAR) AS v, row_number() OVER (ORDER BY COUNT(*) DESC, CAST({e} AS VARCHAR)) - 1 AS idx
  FROM split WHERE is_train GROUP BY 1)""" for a, e in _PLACED]
_PLACES, _BEFORE = [], "0"
for _a, _ in _PLACED:
    _PLACES.append(f"CAST({_BEFORE} + coalesce({_a}.idx, (SELECT COUNT(*) FROM {_a})) AS VARCHAR) || '=1'")
    _BEFORE += f" + (SELECT COUNT(*) + 1 FROM {_a})"
SQL["onehot_vectors"] = _with(SENSOR, _SPLIT, *_CODES) + f"""
SELECT s."Index", {" || ',' || ".join(_PLACES)} AS hot, s.x, s.y, s.z
FROM split s """ + " ".join(f"LEFT JOIN {a} ON CAST({e} AS VARCHAR) = {a}.v" for a, e in _PLACED)
SQL["credits_text_parse_clean"] = _with(CREDIT_NAMES) + """
SELECT id, array_to_string(actors, '|') AS actors, array_to_string(director, '|') AS director
FROM credit_names"""

SQL["pivot_count_filled"] = _with(SENSOR) + 'SELECT usr AS "User", ' + ", ".join(
    f"COUNT(*) FILTER (WHERE gt = {_lit(g)}) AS {_q(g)}" for g in _GT) + """
FROM sensor GROUP BY usr"""

SQL["demand_scalar_long"] = _with(USERS, SEARCHES) + """
SELECT u.user_location, s.year AS value, COUNT(*) AS n
FROM searches s LEFT JOIN users_dim u ON s.id = u.id
WHERE s.year IS NOT NULL
GROUP BY u.user_location, s.year"""

SQL["groups_always_above_long"] = _with(CURTAIN, """m AS (
  SELECT day, month, face, curtain, AVG(value) AS mean_value
  FROM curtain GROUP BY day, month, face, curtain)""") + """
SELECT DISTINCT month, face FROM m
EXCEPT
SELECT DISTINCT month, face FROM m WHERE mean_value < 0.041"""

SQL["decode_json_corrupt"] = """
WITH m AS (
  SELECT event_id, CASE WHEN event_id % 10 = 1 THEN 'dé' ELSE 'dev_' || user_id END AS device FROM events),
w AS (SELECT *, '{"Index": ' || event_id || ', "Device": "' || device || '"}' AS whole FROM m)
SELECT CASE WHEN event_id % 10 NOT IN (0, 2) THEN CAST(event_id AS BIGINT) END AS "Index",
       CASE WHEN event_id % 10 NOT IN (0, 2) THEN device END AS "Device",
       CASE event_id % 10 WHEN 0 THEN substr(whole, 1, 12) WHEN 2 THEN '{}' ELSE whole END AS raw_text,
       event_id % 10 = 0 AS is_corrupt
FROM w"""

SQL["stream_dead_letters"] = f"""
SELECT "Index", "Device", CASE WHEN is_corrupt THEN raw_text END AS raw_text FROM ({SQL['decode_json_corrupt']})"""
