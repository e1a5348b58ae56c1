"""DuckDB SQL for the catalogue, written from the rules apart from the Spark plans."""

from __future__ import annotations

from sievemark.functions.exprs import AGES, GENRES, LAST_OCCUPATION, LAST_YEAR, T1, T2, TS_MAX, TS_MIN
from sievemark.sources.synthetic import VERSION


def _list(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def _in(c: str, values) -> str:
    return f"list_contains({_list(values)}, {c})"


def _trim(c: str) -> str:
    return rf"regexp_replace({c}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def _full(c: str, p: str) -> str:
    return f"regexp_full_match({c}, '{p}')"


def _nth(f: str, i: int) -> str:
    return f"coalesce({f}[{i + 1}], '')"


def _missing(c: str) -> str:
    return f"({_trim(c)} IN ('', 'NULL'))"


def _occupation(c: str) -> str:
    return f"coalesce({_full(c, '[0-9]+')} AND try_cast({c} AS BIGINT) <= {LAST_OCCUPATION}, false)"


def _number(c: str) -> str:
    return f"CASE WHEN {_full(c, '[0-9]+')} THEN try_cast({c} AS BIGINT) END"


def _join(*c: str) -> str:
    return "concat_ws('::', " + ", ".join(c) + ")"


def _ev(when: str, rule: str, action: str, before: str, after: str) -> str:
    return f"CASE WHEN {when} THEN {{'rule': {rule}, 'action': {action}, 'before': {before}, 'after': {after}, 'target': NULL::VARCHAR}} END"


def _evs(keep: str, *e: str) -> str:
    found = "list_filter([" + ",\n    ".join(e) + "], lambda x: x IS NOT NULL)"
    return f"CASE WHEN len({found}) > 0 THEN {found} ELSE [{_ev('true', keep, chr(39) + 'keep' + chr(39), 'payload', 'payload')}] END"


def _source(table: str, key: str) -> str:
    return f"'{table}' AS source_table, '{table}.dat' AS source_file, CAST({key} AS BIGINT) AS source_offset, sha256('{VERSION}' || chr(0) || '{table}' || chr(0) || '{table}.dat' || chr(0) || CAST({key} AS VARCHAR)) AS source_id"


def _distinct(name: str, of: str, key: str, order: str, rule: str) -> str:
    w = f"OVER (PARTITION BY disposition, {key} ORDER BY {order}, source_file, source_offset)"
    return f"""{name}_w AS (SELECT *, row_number() {w} AS place, first_value(source_id) {w} AS best FROM {of}),
{name} AS (SELECT * EXCLUDE (place, best, events, disposition),
  CASE WHEN disposition = 'KEEP' AND place > 1 THEN list_append(events, {{'rule': '{rule}', 'action': 'dedup', 'before': payload, 'after': payload, 'target': best}}) ELSE events END AS events,
  CASE WHEN disposition = 'KEEP' AND place > 1 THEN 'DEDUP' ELSE disposition END AS disposition FROM {name}_w)"""


_S = "source_table, source_file, source_offset, source_id"

RAW = f"""
raw_users_b AS (SELECT c_custkey AS k, CAST(c_custkey + 1 AS VARCHAR) AS i, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS g,
  {_list(AGES)}[c_custkey % 7 + 1] AS a, CAST(c_custkey % 23 AS VARCHAR) AS o, lpad(CAST((c_custkey * 37) % 100000 AS VARCHAR), 5, '0') AS z FROM customer),
raw_users AS (SELECT {_source('users', 'k')}, CASE k % 53 WHEN 0 THEN {_join('i', 'g', 'a', 'o', 'z')} || '::x' WHEN 1 THEN {_join('i', 'g', 'a', 'o')} WHEN 2 THEN concat_ws(':', i, g, a, o, z)
  WHEN 3 THEN {_join('i', "'X'", 'a', 'o', 'z')} WHEN 4 THEN {_join('i', 'g', "'30'", 'o', 'z')} WHEN 5 THEN {_join('i', 'g', 'a', 'o', 'z')} || '-1234' WHEN 6 THEN {_join('i', 'g', 'a', 'o', 'z')} || '6789'
  WHEN 7 THEN {_join('i', 'g', 'a', 'o', "'ABCDE'")} WHEN 8 THEN {_join('CAST(k AS VARCHAR)', 'g', 'a', 'o', 'z')} WHEN 9 THEN concat_ws(' :: ', ' ' || i, g, a, o, z || ' ') ELSE {_join('i', 'g', 'a', 'o', 'z')} END AS raw_record FROM raw_users_b),
raw_movies_b AS (SELECT p_partkey AS k, p_name AS n, CAST(p_partkey + 1 AS VARCHAR) AS i, p_name || ' (' || CAST(1930 + p_partkey % 80 AS VARCHAR) || ')' AS t,
  {_list(GENRES)}[p_partkey % 18 + 1] || '|' || {_list(GENRES)}[p_partkey % 7 + 12] AS g FROM part),
raw_movies AS (SELECT {_source('movies', 'k')}, CASE k % 47 WHEN 0 THEN {_join('i', 't', "'UnknownGenre'")} WHEN 1 THEN {_join('i', 't')} WHEN 2 THEN i || '::::' || g WHEN 3 THEN {_join('i', 'n', 'g')}
  WHEN 4 THEN i || '::' || n || ' CafÃ© (1999)::' || g WHEN 5 THEN {_join('CAST(k AS VARCHAR)', 't', 'g')} WHEN 6 THEN concat_ws(' :: ', i, t, g) WHEN 7 THEN {_join('i', 't', 'g')} || '|Weird' ELSE {_join('i', 't', 'g')} END AS raw_record FROM raw_movies_b),
raw_ratings_b AS (SELECT event_id AS k, user_id + 1 AS un, event_id % 64 + 1 AS mn, CAST(user_id + 1 AS VARCHAR) AS u, CAST(event_id % 64 + 1 AS VARCHAR) AS m, CAST(event_id % 5 + 1 AS VARCHAR) AS r,
  CAST(946684800 + (event_id * 7919) % 100000000 AS VARCHAR) AS t FROM events),
raw_ratings AS (SELECT {_source('ratings', 'k')}, CASE k % 101 WHEN 0 THEN {_join('u', 'm', 'r', 't')} || '::extra' WHEN 1 THEN concat_ws(',', u, m, r, t) WHEN 2 THEN {_join('u', 'm', 'r')} WHEN 3 THEN {_join('u', 'm', "'3.5'", 't')}
  WHEN 4 THEN {_join('u', 'm', "'6'", 't')} WHEN 5 THEN {_join('u', 'm', 'r', "'bad'")} WHEN 6 THEN {_join('u', 'm', 'r', 't')} || '000' WHEN 7 THEN {_join('u', 'm', 'r', "'0'")} WHEN 8 THEN {_join('CAST(un + 1000000 AS VARCHAR)', 'm', 'r', 't')}
  WHEN 9 THEN {_join('u', 'CAST(mn + 2000000 AS VARCHAR)', 'r', 't')} WHEN 10 THEN {_join("'999999'", 'm', 'r', 't')} WHEN 11 THEN concat_ws(' :: ', ' ' || u, m, r, t || ' ') ELSE {_join('u', 'm', 'r', 't')} END AS raw_record FROM raw_ratings_b)"""

_ID = _trim(_nth("string_split(raw_record, '::')", 0))
RAW_IDS = f"""
raw_user_ids AS (SELECT DISTINCT {_ID} AS id FROM raw_users WHERE {_full(_ID, '[0-9]+')}),
raw_movie_ids AS (SELECT DISTINCT {_ID} AS id FROM raw_movies WHERE {_full(_ID, '[0-9]+')})"""

CLEAN = f"""
u1 AS (SELECT *, string_split(raw_record, '::') AS f0, string_split(raw_record, ':') AS c0 FROM raw_users),
u2 AS (SELECT *, len(f0) = 1 AND len(c0) = 5 AND len(list_filter(c0, lambda x: {_trim('x')} = '')) = 0 AS u1c FROM u1),
u3 AS (SELECT *, CASE WHEN u1c THEN c0 ELSE f0 END AS f1 FROM u2),
u4 AS (SELECT *, len(f1) = 6 AND {_full(_trim(_nth('f1', 0)), '[0-9]+')} AND {_full(_trim(_nth('f1', 1)), '[FM]')} AND {_in(_trim(_nth('f1', 2)), AGES)} AND {_occupation(_trim(_nth('f1', 3)))} AS u1a FROM u3),
u5 AS (SELECT *, CASE WHEN u1a THEN f1[1:5] ELSE f1 END AS f2 FROM u4),
u6 AS (SELECT *, array_to_string(f1, '::') AS p1, array_to_string(f2, '::') AS p2, {', '.join(f"{_trim(_nth('f2', i))} AS {n}" for i, n in enumerate(('uid', 'g', 'a', 'o', 'z')))} FROM u5),
u7 AS (SELECT *, len(f2) = 5 AND {_full('uid', '[0-9]+')} AS ok, {_full('g', '[FM]')} AS gk, {_in('a', AGES)} AS ak, {_occupation('o')} AS ok_o,
  CASE WHEN {_full('z', '[0-9]{5}-[0-9]{4}')} THEN 'U5a' WHEN {_full('z', '[0-9]{9}')} THEN 'U5b' WHEN NOT {_full('z', '[0-9]{5}')} THEN 'U5c' END AS u5 FROM u6),
u8 AS (SELECT *, CASE WHEN gk THEN g ELSE 'NULL' END AS g2, CASE WHEN ak THEN a ELSE 'NULL' END AS a2, CASE WHEN ok_o THEN o ELSE 'NULL' END AS o2, CASE WHEN u5 = 'U5c' THEN 'NULL' ELSE substr(z, 1, 5) END AS z2 FROM u7),
u9 AS (SELECT *, {_join('uid', 'g', 'a', 'o', 'z')} AS p3, {_join('uid', 'g2', 'a', 'o', 'z')} AS p4, {_join('uid', 'g2', 'a2', 'o', 'z')} AS p5, {_join('uid', 'g2', 'a2', 'o2', 'z')} AS p6, {_join('uid', 'g2', 'a2', 'o2', 'z2')} AS p7 FROM u8),
u10 AS (SELECT *, CASE WHEN ok THEN p7 ELSE p2 END AS payload, CASE WHEN ok THEN 'KEEP' ELSE 'ISOLATE' END AS disposition, gk::INT + ak::INT + ok_o::INT + (z2 <> 'NULL')::INT AS score FROM u9),
u11 AS (SELECT {_S}, raw_record, payload, disposition, uid, score, {_evs("'U0'", _ev('u1c', "'U1c'", "'repair'", 'raw_record', 'p1'), _ev('u1a', "'U1a'", "'repair'", 'p1', 'p2'), _ev('NOT ok', "'U1b'", "'isolate'", 'p2', 'p2'), _ev('ok AND p3 <> p2', "'U0'", "'repair'", 'p2', 'p3'), _ev('ok AND NOT gk', "'U2'", "'log'", 'p3', 'p4'), _ev('ok AND NOT ak', "'U3'", "'log'", 'p4', 'p5'), _ev('ok AND NOT ok_o', "'U4'", "'log'", 'p5', 'p6'), _ev('ok AND u5 IS NOT NULL', 'u5', "CASE WHEN u5 = 'U5c' THEN 'log' ELSE 'repair' END", 'p6', 'p7'))} AS events FROM u10),
{_distinct('cu', 'u11', 'uid', 'score DESC', 'U6')},
m1 AS (SELECT *, string_split(raw_record, '::') AS f0 FROM raw_movies),
m2 AS (SELECT *, {', '.join(f"{_trim(_nth('f0', i))} AS {n}" for i, n in enumerate(('mid', 't1', 'g1')))} FROM m1),
m3 AS (SELECT *, replace(t1, 'Ã©', 'é') AS t2, len(f0) = 3 AND {_full('mid', '[0-9]+')} AS three FROM m2),
m4 AS (SELECT *, three AND t2 <> '' AS ok, nullif(regexp_extract(t2, '\\(([0-9]{{4}})\\)\\s*$', 1), '') AS yr,
  coalesce(nullif(array_to_string(list_filter(list_transform(string_split(g1, '|'), lambda x: {_trim('x')}), lambda x: {_in('x', GENRES)}), '|'), ''), 'NULL') AS g2 FROM m3),
m5 AS (SELECT *, {_join('mid', 't1', 'g1')} AS p1, {_join('mid', 't2', 'g1')} AS p2, {_join('mid', 't2', 'g2')} AS p3 FROM m4),
m6 AS (SELECT *, CASE WHEN ok THEN p3 WHEN three THEN p2 ELSE raw_record END AS payload, CASE WHEN ok THEN 'KEEP' ELSE 'ISOLATE' END AS disposition, (yr IS NOT NULL)::INT + (g2 <> 'NULL')::INT AS score,
  CASE WHEN yr IS NOT NULL THEN lower({_trim(r"regexp_replace(t2, '\s*\([0-9]{4}\)\s*$', '')")}) || '|' || yr ELSE source_id END AS tk FROM m5),
m7 AS (SELECT {_S}, raw_record, payload, disposition, mid, score, tk, {_evs("'M0'", _ev('three AND p1 <> raw_record', "'M1'", "'repair'", 'raw_record', 'p1'), _ev('three AND t2 <> t1', "'M8'", "'repair'", 'p1', 'p2'), _ev('NOT ok', "'M2'", "'isolate'", 'payload', 'payload'), _ev('ok AND g2 <> g1', "'M4'", "CASE WHEN g2 = 'NULL' THEN 'log' ELSE 'repair' END", 'p2', 'p3'), _ev(f'ok AND (yr IS NULL OR CAST(yr AS INT) > {LAST_YEAR})', "'M3'", "'log'", 'p3', 'p3'))} AS events FROM m6),
{_distinct('cm1', 'm7', 'mid', 'score DESC', 'M5a')},
{_distinct('cm', 'cm1', 'tk', 'score DESC', 'M5b')},
user_ids AS (SELECT DISTINCT split_part(payload, '::', 1) AS id FROM cu WHERE disposition = 'KEEP'),
movie_ids AS (SELECT DISTINCT split_part(payload, '::', 1) AS id FROM cm WHERE disposition = 'KEEP'),
r1 AS (SELECT *, string_split(raw_record, '::') AS f0, string_split(raw_record, ',') AS c0 FROM raw_ratings),
r2 AS (SELECT *, len(f0) = 1 AND len(c0) = 4 AS r1b FROM r1),
r3 AS (SELECT *, CASE WHEN r1b THEN c0 ELSE f0 END AS f1 FROM r2),
r4 AS (SELECT *, len(f1) = 5 AS r1a, CASE WHEN len(f1) = 5 THEN f1[1:4] ELSE f1 END AS f2 FROM r3),
r5 AS (SELECT *, array_to_string(f1, '::') AS p1, array_to_string(f2, '::') AS p2, len(f2) = 4 AND len(list_filter(f2, lambda x: {_trim('x')} = '')) = 0 AS four, {', '.join(f"{_trim(_nth('f2', i))} AS {n}" for i, n in enumerate('umrt'))} FROM r4),
r6 AS (SELECT *, {_number('t')} AS n FROM r5),
r7 AS (SELECT *, coalesce(n > 1000000000000, false) AS ms, CASE WHEN n > 1000000000000 THEN n // 1000 ELSE n END AS ts FROM r6),
r8 AS (SELECT *, CASE WHEN NOT four OR NOT {_full('u', '[0-9]+')} OR NOT {_full('m', '[0-9]+')} THEN 'R1c' WHEN NOT {_full('r', '[1-5]')} THEN CASE WHEN {_full('r', '[0-9]+')} THEN 'R3' ELSE 'R2' END WHEN n IS NULL THEN 'R4' WHEN ts < {TS_MIN} OR ts > {TS_MAX} THEN 'R6' END AS bad,
  {', '.join(f"CASE WHEN length({x}) >= 7 AND try_cast({x} AS BIGINT) > 1000000 THEN CAST(CASE WHEN CAST({x} AS BIGINT) > 2000000 THEN CAST({x} AS BIGINT) - 2000000 ELSE CAST({x} AS BIGINT) - 1000000 END AS VARCHAR) END AS {x}c" for x in 'um')} FROM r7),
r9 AS (SELECT *, u IN (SELECT id FROM user_ids) AS uk, m IN (SELECT id FROM movie_ids) AS mk, coalesce(uc IN (SELECT id FROM user_ids), false) AS uck, coalesce(mc IN (SELECT id FROM movie_ids), false) AS mck FROM r8),
r10 AS (SELECT *, NOT uk AND uck AS r8a, NOT mk AND mck AS r8b, CAST(ts AS VARCHAR) AS s FROM r9),
r11 AS (SELECT *, CASE WHEN r8a THEN uc ELSE u END AS u2, CASE WHEN r8b THEN mc ELSE m END AS m2, coalesce(bad, CASE WHEN NOT ((uk OR r8a) AND (mk OR r8b)) THEN 'R9' END) AS why FROM r10),
r12 AS (SELECT *, {_join('u', 'm', 'r', 't')} AS p3, {_join('u', 'm', 'r', 's')} AS p4, {_join('u2', 'm', 'r', 's')} AS p5, {_join('u2', 'm2', 'r', 's')} AS p6 FROM r11),
r13 AS (SELECT *, CASE WHEN bad IS NULL THEN p6 WHEN bad = 'R6' THEN p4 WHEN four THEN p3 ELSE p2 END AS payload, CASE WHEN why IS NULL THEN 'KEEP' ELSE 'ISOLATE' END AS disposition FROM r12),
r14 AS (SELECT {_S}, raw_record, payload, disposition, u2 || '|' || m2 AS pair, ts, {_evs("'R0'", _ev('r1b', "'R1b'", "'repair'", 'raw_record', 'p1'), _ev('r1a', "'R1a'", "'repair'", 'p1', 'p2'), _ev('four AND p3 <> p2', "'R0'", "'repair'", 'p2', 'p3'), _ev("(bad IS NULL OR bad = 'R6') AND ms", "'R5'", "'repair'", 'p3', 'p4'), _ev('bad IS NULL AND r8a', "'R8a'", "'repair'", 'p4', 'p5'), _ev('bad IS NULL AND r8b', "'R8b'", "'repair'", 'p5', 'p6'), _ev('why IS NOT NULL', 'why', "'isolate'", 'payload', 'payload'))} AS events FROM r13),
{_distinct('cr', 'r14', 'pair', 'ts DESC', 'R7')},
cleaned AS MATERIALIZED ({' UNION ALL '.join(f'SELECT {_S}, raw_record, payload, events, disposition FROM {t}' for t in ('cu', 'cm', 'cr'))}),
evs AS (SELECT source_table, source_id, source_offset, disposition, unnest(range(len(events)))::INT AS event_order, unnest(events) AS e FROM cleaned),
ev AS MATERIALIZED (SELECT source_table, source_id, source_offset, disposition, event_order, e.rule AS rule, e.action AS action, e.before AS before, e.after AS after, e.target AS target FROM evs)"""

_F = [_nth("f", i) for i in range(5)]


def _present(first: int, last: int) -> str:
    return f"len(list_filter(f[{first + 1}:{last}], lambda x: NOT {_missing('x')}))::INT"


def _users(of: str, line: str, phase: str) -> str:
    base = f"len(f) = 5 AND {_full(_F[0], '[0-9]+')} AND {_full(_F[1], '[FM]')} AND {_in(_F[2], AGES)} AND {_occupation(_F[3])}"
    return f"""SELECT {_S}, ({base} AND {_full(_F[4], '[0-9]{5}')})::INT AS accurate, {_present(0, 5)} AS present, 5 AS required, ({base} AND {_full(_F[4], '[0-9]{5}(-[0-9]{4})?')})::INT AS consistent,
  NULL::INT AS up_to_date, NULL::VARCHAR AS split, CASE WHEN len(f) = 5 AND {_full(_F[0], '[0-9]+')} THEN 'U:' || {_F[0]} ELSE 'ROW:' || source_id END AS business_key, '{phase}' AS phase
FROM (SELECT *, string_split({line}, '::') AS f FROM {of})"""


def _movies(of: str, line: str, phase: str) -> str:
    legal = f"({_trim(_F[2])} <> '' AND (rtrim({_F[2]}, '|') = '' OR len(list_filter(string_split(rtrim({_F[2]}, '|'), '|'), lambda x: NOT {_in(_trim('x'), GENRES)})) = 0))"
    return f"""SELECT {_S}, coalesce(len(f) = 3 AND title <> '' AND {legal} AND CAST(yr AS INT) <= {LAST_YEAR}, false)::INT AS accurate, {_present(1, 3)} AS present, 2 AS required,
  (len(f) = 3 AND title <> '' AND {legal} AND {_full(_F[0], '[0-9]+')} AND yr IS NOT NULL)::INT AS consistent, NULL::INT AS up_to_date, NULL::VARCHAR AS split,
  CASE WHEN plain <> '' AND yr IS NOT NULL THEN 'M:' || CAST(to_json([plain, yr]) AS VARCHAR) ELSE 'ROW:' || source_id END AS business_key, '{phase}' AS phase
FROM (SELECT *, nullif(regexp_extract(title, '\\(([0-9]{{4}})\\)\\s*$', 1), '') AS yr, lower({_trim(r"regexp_replace(title, '\s*\([0-9]{4}\)\s*$', '')")}) AS plain
  FROM (SELECT *, {_trim(_nth('f', 1))} AS title FROM (SELECT *, string_split({line}, '::') AS f FROM {of})))"""


def _ratings(of: str, line: str, phase: str, users: str, movies: str) -> str:
    ids = f"{_full('u', '[0-9]+')} AND {_full('m', '[0-9]+')}"
    return f"""SELECT {_S}, coalesce(len(f) = 4 AND {ids} AND {_full('r', '[1-5]')} AND ts BETWEEN {TS_MIN} AND {TS_MAX} AND u IN (SELECT id FROM {users}) AND m IN (SELECT id FROM {movies}), false)::INT AS accurate,
  {_present(0, 4)} AS present, 4 AS required, (len(f) = 4 AND {ids} AND {_full('r', '[1-5]')} AND {_full('t', '[0-9]{9,10}')})::INT AS consistent, coalesce(ts BETWEEN {TS_MIN} AND {TS_MAX}, false)::INT AS up_to_date,
  CASE WHEN ts <= {T1} THEN 'TRAIN' WHEN ts <= {T2} THEN 'VALID' WHEN ts IS NOT NULL THEN 'TEST' END AS split,
  CASE WHEN len(f) >= 2 AND {ids} THEN 'R:' || CAST(to_json([u, m]) AS VARCHAR) ELSE 'ROW:' || source_id END AS business_key, '{phase}' AS phase
FROM (SELECT *, CASE WHEN len(f) = 4 THEN {_number('t')} END AS ts FROM (SELECT *, {', '.join(f"{_trim(_nth('f', i))} AS {n}" for i, n in enumerate('umrt'))} FROM (SELECT *, string_split({line}, '::') AS f FROM {of})))"""


_KEPT = "(SELECT * FROM {} WHERE disposition = 'KEEP')"
SEEN = f"""
seen AS ({_users('raw_users', 'raw_record', 'before')} UNION ALL {_movies('raw_movies', 'raw_record', 'before')} UNION ALL {_ratings('raw_ratings', 'raw_record', 'before', 'raw_user_ids', 'raw_movie_ids')}
  UNION ALL {_users(_KEPT.format('cu'), 'payload', 'after')} UNION ALL {_movies(_KEPT.format('cm'), 'payload', 'after')} UNION ALL {_ratings(_KEPT.format('cr'), 'payload', 'after', 'user_ids', 'movie_ids')}),
uniq AS (SELECT *, (row_number() OVER (PARTITION BY phase, source_table, business_key ORDER BY source_file, source_offset) = 1)::INT AS unique_primary FROM seen),
cnt AS (SELECT phase, source_table, count(*) AS n, sum(accurate)::BIGINT AS acc, sum(present)::BIGINT AS comp, sum(consistent)::BIGINT AS cons, coalesce(sum(up_to_date), 0)::BIGINT AS ud,
  count(*) FILTER (split = 'TRAIN') AS train, count(*) FILTER (split = 'VALID') AS valid, count(*) FILTER (split = 'TEST') AS test, count(*) - count(DISTINCT business_key) AS uniq_excess, max(required) AS required FROM seen GROUP BY 1, 2),
summ AS (SELECT phase, source_table, metric, numerator, denominator, CASE WHEN denominator > 0 THEN 100.0::DOUBLE * numerator / denominator WHEN denominator = 0 THEN 0.0::DOUBLE END AS score FROM (
  SELECT phase, source_table, 'accurate' AS metric, acc AS numerator, n AS denominator FROM cnt UNION ALL SELECT phase, source_table, 'complete', comp, n * required FROM cnt
  UNION ALL SELECT phase, source_table, 'unique', n - uniq_excess, n FROM cnt UNION ALL SELECT phase, source_table, 'consistent', cons, n FROM cnt
  UNION ALL SELECT phase, source_table, 'up_to_date', CASE WHEN source_table = 'ratings' THEN ud END, CASE WHEN source_table = 'ratings' THEN n END FROM cnt))"""

_RAW = f"WITH {RAW},{RAW_IDS}\n"
_CLEAN = f"WITH {RAW},{RAW_IDS},{CLEAN}\n"
_SEEN = f"WITH {RAW},{RAW_IDS},{CLEAN},{SEEN}\n"
_SHORT = "SELECT source_table, source_offset, source_id, payload, disposition, array_to_string(list_transform(events, lambda e: e.action || ':' || e.rule), ',') AS rules FROM "
_CNT = "n, acc, comp, cons, ud, train, valid, test, uniq_excess"
_WINNER = "edge AS MATERIALIZED (SELECT source_table, source_id, rule, target FROM ev WHERE action = 'dedup'), winner AS (SELECT a.source_table, a.source_id, coalesce(b.target, a.target) AS winner, CASE WHEN b.target IS NULL THEN 1 ELSE 2 END AS hops FROM edge a LEFT JOIN edge b ON a.target = b.source_id)"

SQL: dict[str, str] = {
    "extract_user_ids": _RAW + "SELECT id FROM raw_user_ids",
    "extract_movie_ids": _RAW + "SELECT id FROM raw_movie_ids",
    "clean_users": _CLEAN + _SHORT + "cu",
    "clean_movies": _CLEAN + _SHORT + "cm",
    "clean_ratings": _CLEAN + _SHORT + "cr",
    "dispositions": _CLEAN + "SELECT source_table, source_offset, source_id, raw_record, payload, disposition FROM cleaned",
    "quarantine_by_rule": _CLEAN + "SELECT source_table, events[-1].rule AS rule, count(*) AS n FROM cleaned WHERE disposition = 'ISOLATE' GROUP BY 1, 2",
    "action_counts": _CLEAN + "SELECT source_table, action, rule, count(*) AS n FROM ev WHERE action <> 'keep' OR disposition = 'KEEP' GROUP BY 1, 2, 3",
    "source_balance": _CLEAN + "SELECT source_table, count(*) AS raw, count(*) FILTER (disposition = 'KEEP') AS keep, count(*) FILTER (disposition = 'ISOLATE') AS isolate, count(*) FILTER (disposition = 'DEDUP') AS dedup FROM cleaned GROUP BY 1",
    "evidence_events": _CLEAN + "SELECT source_table, source_id, disposition, event_order, rule, action, before, after, target FROM ev",
    "evidence_quality": _SEEN + """SELECT phase, source_table, source_id, metric, numerator, denominator FROM (
  SELECT phase, source_table, source_id, 'accurate' AS metric, accurate::BIGINT AS numerator, 1 AS denominator FROM uniq UNION ALL SELECT phase, source_table, source_id, 'complete', present, required FROM uniq
  UNION ALL SELECT phase, source_table, source_id, 'unique', unique_primary, 1 FROM uniq UNION ALL SELECT phase, source_table, source_id, 'up_to_date', up_to_date, 1 FROM uniq UNION ALL SELECT phase, source_table, source_id, 'consistent', consistent, 1 FROM uniq) WHERE numerator IS NOT NULL""",
    "quality_detail": _SEEN + "SELECT source_table, source_offset, source_id, accurate, present, required, consistent, up_to_date, business_key, phase, unique_primary FROM uniq",
    "quality_groups": _SEEN + "SELECT phase, source_table, business_key, count(*) AS records, count(*) - 1 AS duplicate_excess FROM seen GROUP BY 1, 2, 3",
    "score_counters": _SEEN + f"SELECT phase, source_table, {_CNT} FROM cnt",
    "counter_scan": _SEEN + f"SELECT phase, source_table, {_CNT} FROM cnt",
    **{f"score_{t}_{p}": _SEEN + f"SELECT {_CNT} FROM cnt WHERE source_table = '{t}' AND phase = '{ph}'" for t in ("users", "movies", "ratings") for p, ph in (("raw", "before"), ("clean", "after"))},
    "quality_summary": _SEEN + "SELECT * FROM summ",
    "five_dimensions": _SEEN + "SELECT phase, source_table, " + ", ".join(f"max(score) FILTER (metric = '{m}') AS {m}" for m in ("accurate", "complete", "unique", "up_to_date", "consistent")) + " FROM summ GROUP BY 1, 2",
    "composites": _SEEN + """, c AS (SELECT phase, source_table, sum(score) / count(score) AS composite FROM summ GROUP BY 1, 2)
SELECT phase, source_table AS scope, round(composite, 6) AS composite FROM c UNION ALL
SELECT phase, 'dataset', round(max(composite) FILTER (source_table = 'ratings') * 0.6::DOUBLE + max(composite) FILTER (source_table = 'users') * 0.2::DOUBLE + max(composite) FILTER (source_table = 'movies') * 0.2::DOUBLE, 6) FROM c GROUP BY 1""",
    "temporal_split": _SEEN + "SELECT phase, split, count(*) AS n FROM seen WHERE split IS NOT NULL GROUP BY 1, 2",
    "row_change": _SEEN + "SELECT source_table, max(n) FILTER (phase = 'before') AS raw, max(n) FILTER (phase = 'after') AS clean, max(n) FILTER (phase = 'before') - max(n) FILTER (phase = 'after') AS removed FROM cnt GROUP BY 1",
    "dedup_edges": _CLEAN + "SELECT source_table, source_id, rule, target FROM ev WHERE action = 'dedup'",
    "dedup_winner_graph": _CLEAN + f", {_WINNER} SELECT * FROM winner",
    "dedup_lineage": _CLEAN + f", {_WINNER} SELECT source_table, winner, count(DISTINCT source_id)::INT AS n_related, array_to_string(list_sort(list(DISTINCT source_id)), ',') AS related FROM winner GROUP BY 1, 2",
    "rating_distribution": _CLEAN + "SELECT split_part(payload, '::', 3) AS rating, count(*) AS n FROM cr WHERE disposition = 'KEEP' GROUP BY 1 ORDER BY 1",
    "dangling_references": _RAW + f""", x AS (SELECT {_trim('f[1]')} AS u, {_trim('f[2]')} AS m FROM (SELECT string_split(raw_record, '::') AS f FROM raw_ratings) WHERE len(f) = 4)
SELECT 'user' AS kind, u AS id, count(*) AS n FROM x WHERE u NOT IN (SELECT id FROM raw_user_ids) GROUP BY u UNION ALL SELECT 'movie', m, count(*) FROM x WHERE m NOT IN (SELECT id FROM raw_movie_ids) GROUP BY m""",
    "id_offset_repair": _CLEAN + "SELECT source_id, rule, before, after FROM ev WHERE rule IN ('R8a', 'R8b')",
    "mojibake_titles": _CLEAN + "SELECT source_id, before, after FROM ev WHERE rule = 'M8'",
    "genre_normalise": _CLEAN + "SELECT source_id, action, before, after FROM ev WHERE rule = 'M4'",
    "genre_violations": _RAW + f"""SELECT source_offset, f[3] AS genres FROM (SELECT source_offset, string_split(raw_record, '::') AS f FROM raw_movies) WHERE len(f) = 3
  AND ({_trim('f[3]')} = '' OR (rtrim(f[3], '|') <> '' AND len(list_filter(string_split(rtrim(f[3], '|'), '|'), lambda x: NOT {_in(_trim('x'), GENRES)})) > 0))""",
    "zip_masks": _RAW + "SELECT regexp_replace(f[5], '[0-9]', '9', 'g') AS mask, count(*) AS n FROM (SELECT string_split(raw_record, '::') AS f FROM raw_users) WHERE len(f) = 5 AND NOT list_contains(f, '') GROUP BY 1 ORDER BY n DESC, mask LIMIT 10",
    "validation_gates": _CLEAN + f""", {_WINNER}, w AS (SELECT winner.*, c.disposition AS fin FROM winner LEFT JOIN cleaned c ON c.source_id = winner.winner),
k AS (SELECT * FROM cleaned WHERE disposition = 'KEEP')
SELECT 'population' AS gate, (SELECT count(*) FROM (SELECT source_id FROM raw_users UNION ALL SELECT source_id FROM raw_movies UNION ALL SELECT source_id FROM raw_ratings) WHERE source_id NOT IN (SELECT source_id FROM cleaned)) AS violations
UNION ALL SELECT 'unique_source', count(*) FROM (SELECT 1 FROM cleaned GROUP BY source_id HAVING count(*) > 1)
UNION ALL SELECT 'origin_chain', count(*) FROM cleaned WHERE NOT (events[1].before = raw_record AND events[-1].after = payload AND len(list_filter(range(2, len(events) + 1), lambda i: events[i].before <> events[i - 1].after)) = 0)
UNION ALL SELECT 'terminal_action', count(*) FROM cleaned WHERE (disposition = 'ISOLATE') <> (events[-1].action = 'isolate') OR (disposition = 'DEDUP') <> (events[-1].action = 'dedup')
UNION ALL SELECT 'dedup_target', count(*) FROM w WHERE fin IS NULL OR fin <> 'KEEP'
UNION ALL SELECT 'one_edge', count(*) FROM (SELECT 1 FROM ev WHERE action = 'dedup' GROUP BY source_id HAVING count(*) > 1)
UNION ALL SELECT 'user_reference', count(*) FROM k WHERE source_table = 'ratings' AND split_part(payload, '::', 1) NOT IN (SELECT id FROM user_ids)
UNION ALL SELECT 'movie_reference', count(*) FROM k WHERE source_table = 'ratings' AND split_part(payload, '::', 2) NOT IN (SELECT id FROM movie_ids)
UNION ALL SELECT 'genres_distinct', count(*) FROM (SELECT string_split(split_part(payload, '::', 3), '|') AS g FROM k WHERE source_table = 'movies') WHERE len(list_distinct(g)) < len(g)""",
    "orphan_rows": _SEEN + "SELECT 'evidence' AS kind, source_table, count(*) AS n FROM ev WHERE source_offset % 37 = 0 GROUP BY 2 UNION ALL SELECT 'quality', source_table, count(*) FROM seen WHERE source_offset % 37 = 0 GROUP BY 2",
    "group_reconciliation": _SEEN + "SELECT phase, source_table, (count(*) - count(DISTINCT business_key))::BIGINT AS declared, count(*) AS records, sum(1 - unique_primary)::BIGINT AS recomputed, count(*) - count(DISTINCT business_key) = sum(1 - unique_primary) AS equal FROM uniq GROUP BY 1, 2",
    "samples_per_stream": _CLEAN + "SELECT source_table, disposition, place::INT AS place, payload FROM (SELECT *, row_number() OVER (PARTITION BY source_table, disposition ORDER BY source_file, source_offset) AS place FROM cleaned) WHERE place <= 3",
    "source_fingerprint": _RAW + "SELECT source_table, count(*) AS n, min(h) AS first, max(h) AS last, count(DISTINCT h) AS distinct_lines FROM (SELECT source_table, sha256(raw_record) AS h FROM raw_users UNION ALL SELECT source_table, sha256(raw_record) FROM raw_movies UNION ALL SELECT source_table, sha256(raw_record) FROM raw_ratings) GROUP BY 1",
    "multiset_diff": _CLEAN + "SELECT payload, sum(side)::BIGINT AS surplus FROM (SELECT payload, 1 AS side FROM cr WHERE disposition = 'KEEP' UNION ALL SELECT payload, -1 FROM cr WHERE disposition = 'KEEP' AND CAST(split_part(payload, '::', 4) AS BIGINT) <= 1025481600) GROUP BY 1 HAVING sum(side) <> 0",
}

_COUNTS = "SELECT unnest([{}]) AS measure, unnest([{}])::BIGINT AS n FROM ({})"


def _profile(checks: dict[str, str], of: str) -> str:
    names = ", ".join(f"'{k}'" for k in checks)
    return f"SELECT unnest([{names}]) AS measure, unnest([{', '.join(checks.values())}])::BIGINT AS n FROM ({of})"


def _if(c: str) -> str:
    return f"count(*) FILTER ({c})"


def _fields(table: str, names: str) -> str:
    return f"SELECT source_offset, raw_record, len(f) AS width, {', '.join(f'{_nth(chr(102), i)} AS {n}' for i, n in enumerate(names.split()))} FROM (SELECT *, string_split(raw_record, '::') AS f FROM {table})"


def _agg(checks: dict[str, str], of: str) -> str:
    return _profile({k: k for k in checks}, "SELECT " + ", ".join(f"{v} AS {k}" for k, v in checks.items()) + f" FROM {of}")


_YEAR_END = r"'[(][0-9]{4}[)]\s*$'"


def _complete(names: str) -> str:
    n = names.split()
    return f"(width = {len(n)} AND " + " AND ".join(f"{c} <> ''" for c in n) + ")"


_LEGAL = [str(i) for i in range(21)]
SQL["profile_users"] = _RAW + f""", d AS ({_fields('raw_users', 'id g a o z')}),
w AS (SELECT *, row_number() OVER x AS rn, lag(raw_record) OVER x AS prev FROM d WHERE width = 5 WINDOW x AS (PARTITION BY id ORDER BY source_offset))
{_agg({'total': 'count(*)', 'wrong_width': _if('width <> 5')}, 'd')} UNION ALL
{_agg({'repeated_id': _if('rn > 1'), 'conflicting_id': _if('raw_record <> prev'), 'bad_id': _if('NOT ' + _full('id', '[0-9]+')), 'bad_gender': _if("g NOT IN ('F', 'M')"), 'bad_age': _if('NOT ' + _in('a', AGES)), 'bad_occupation': _if('NOT ' + _in('o', _LEGAL)), 'bad_zip': _if('NOT ' + _full('z', '[0-9]{5}(-[0-9]{4})?')), 'distinct_id': 'count(DISTINCT id)'}, 'w')}"""
SQL["profile_movies"] = _RAW + f""", d AS ({_fields('raw_movies', 'id t g')}),
w AS (SELECT *, row_number() OVER x AS rn, lag(raw_record) OVER x AS prev, CASE WHEN trim(g) = '' THEN [] ELSE string_split(g, '|') END AS gs FROM d WHERE width = 3 WINDOW x AS (PARTITION BY id ORDER BY source_offset))
{_agg({'total': 'count(*)', 'wrong_width': _if('width <> 3')}, 'd')} UNION ALL
{_agg({'repeated_id': _if('rn > 1'), 'conflicting_id': _if('raw_record <> prev'), 'bad_id': _if('NOT ' + _full('id', '[0-9]+')), 'empty_title': _if(_trim('t') + " = ''"), 'mojibake': _if("regexp_matches(t, 'Ã|Â|â|€|¢|ð')"), 'no_year': _if("NOT regexp_matches(t, '[(][0-9]{4}[)]\\s*$')"), 'empty_genres': _if(_trim('g') + " = ''"), 'repeated_genre': _if('len(list_distinct(gs)) < len(gs)'), 'unknown_genres': f"coalesce(sum(len(list_filter(gs, lambda x: NOT {_in('x', GENRES)}))), 0)", 'distinct_id': 'count(DISTINCT id)'}, 'w')}"""
SQL["profile_ratings"] = _RAW + f""", d AS ({_fields('raw_ratings', 'u m r t')}),
w AS (SELECT *, {_number('t')} AS ts, row_number() OVER x AS rn, first_value(r) OVER x AS r1 FROM d WHERE width = 4 WINDOW x AS (PARTITION BY u, m ORDER BY source_offset)),
p AS (SELECT u, m, count(*) AS k FROM w GROUP BY 1, 2)
{_agg({'total': 'count(*)', 'wrong_width': _if('width <> 4')}, 'd')} UNION ALL
{_agg({'bad_user': _if('NOT ' + _full('u', '[0-9]+')), 'bad_movie': _if('NOT ' + _full('m', '[0-9]+')), 'bad_rating': _if('NOT ' + _full('r', '[1-5]')), 'bad_time': _if('ts IS NULL'), 'time_outside': _if('ts NOT BETWEEN 788918400 AND 1104537600'), 'extra_rows': _if('rn > 1'), 'rating_conflict': _if('r <> r1'), 'unknown_user': _if(_full('u', '[0-9]+') + ' AND u NOT IN (SELECT id FROM raw_user_ids)'), 'unknown_movie': _if(_full('m', '[0-9]+') + ' AND m NOT IN (SELECT id FROM raw_movie_ids)'), 'first_time': 'min(ts) FILTER (ts BETWEEN 788918400 AND 1104537600)', 'last_time': 'max(ts) FILTER (ts BETWEEN 788918400 AND 1104537600)'}, 'w')} UNION ALL
{_agg({'distinct_pairs': 'count(*)', 'repeated_pairs': _if('k > 1')}, 'p')}"""
SQL["ratings_per_user_stats"] = _RAW + f""", p AS (SELECT u, count(*) AS k FROM ({_fields('raw_ratings', 'u m r t')}) WHERE {_complete('u m r t')} GROUP BY 1)
SELECT count(*) AS users, min(k) AS least, list_sort(list(k))[count(*) // 2 + 1] AS upper_median, max(k) AS most, count(*) FILTER (k > 2000) AS heavy FROM p"""
SQL["id_gaps"] = _RAW + f", p AS (SELECT id, {_number('id')} AS i FROM ({_fields('raw_movies', 'id t g')}) WHERE {_complete('id t g')}) SELECT min(i) AS low, max(i) AS high, max(i) - min(i) + 1 - count(DISTINCT id) AS gaps FROM p"
SQL["title_conflicts"] = _RAW + f""", d AS (SELECT *, {_trim(f"regexp_replace(t, {_YEAR_END}, '')")} AS name FROM ({_fields('raw_movies', 'id t g')}) WHERE {_complete('id t g')}), p AS (SELECT id, count(DISTINCT t) AS t, count(DISTINCT g) AS g, count(*) AS k FROM d GROUP BY 1)
SELECT 'name_with_ids' AS kind, count(*) AS n FROM (SELECT name FROM d GROUP BY name HAVING count(DISTINCT id) > 1) UNION ALL SELECT 'id_with_titles', count(*) FILTER (t > 1) FROM p UNION ALL SELECT 'id_with_genres', count(*) FILTER (g > 1) FROM p UNION ALL SELECT 'id_with_rows', count(*) FILTER (k > 1) FROM p"""

_P = [f"CASE WHEN split_part(payload, '::', {i}) <> 'NULL' THEN split_part(payload, '::', {i}) END" for i in range(1, 6)]
_REL = f", {_WINNER}, rel AS (SELECT winner, array_to_string(list_sort(list(DISTINCT source_id)), ',') AS related FROM winner GROUP BY 1)\n"


def _explored(table: str, names: str, more: str = "") -> str:
    return _RAW + f", d AS (SELECT *, {_complete(names)} AS ok{more} FROM ({_fields('raw_' + table, names)}))"


SQL["explore_users"] = _explored("users", "id g a o z") + f""", p AS (SELECT id, count(*) AS k, count(DISTINCT (g, a, o, z)) AS v, min(g) AS gender FROM d WHERE ok GROUP BY 1)
{_agg({'incomplete': _if('NOT ok'), 'bad_gender': _if("ok AND g NOT IN ('F', 'M')"), 'bad_age': _if(f"ok AND NOT coalesce(list_contains([{', '.join(AGES)}], {_number('a')}), false)"), 'bad_occupation': _if('ok AND NOT ' + _occupation('o')), 'bad_zip': _if('ok AND NOT ' + _full('z', '[0-9]{5}'))}, 'd')} UNION ALL
{_agg({'id_with_rows': _if('k > 1'), 'id_with_attributes': _if('v > 1')}, 'p')} UNION ALL
SELECT 'gender_' || gender, count(*) FROM p GROUP BY 1"""
SQL["explore_movies"] = _explored("movies", "id t g", ", list_transform(string_split(g, '|'), lambda x: " + _trim("x") + ") AS gs") + f""", p AS (SELECT {_trim(f"regexp_replace(t, {_YEAR_END}, '')")} AS name, count(DISTINCT id) AS k FROM d WHERE ok GROUP BY 1)
{_agg({'incomplete': _if('NOT ok'), 'beyond_ascii': _if('ok AND octet_length(encode(t)) > length(t)'), 'padded_title': _if(f"ok AND {_trim('t')} <> t"), 'no_year': _if(f"ok AND NOT regexp_matches(t, {_YEAR_END})"), 'empty_genres': _if(f"ok AND {_trim('g')} = ''"), 'unknown_genre': _if(f"ok AND len(list_filter(gs, lambda x: NOT {_in('x', GENRES)})) > 0")}, 'd')} UNION ALL
{_agg({'name_with_ids': _if('k > 1')}, 'p')}"""
SQL["explore_ratings"] = _explored("ratings", "u m r t", f", {_number('r')} AS rv, {_number('t')} AS ts") + f""", p AS (SELECT u, m, count(*) AS k, count(DISTINCT rv) AS v FROM d WHERE ok GROUP BY 1, 2)
{_agg({'incomplete': _if('NOT ok'), 'no_integer': _if('ok AND rv IS NULL'), 'outside_1_5': _if('ok AND rv NOT BETWEEN 1 AND 5'), 'no_time': _if('ok AND ts IS NULL'), 'time_implausible': _if('width = 4 AND ts NOT BETWEEN 631123200 AND 1047791999'), 'first_time': 'min(ts) FILTER (ok)', 'last_time': 'max(ts) FILTER (ok)'}, 'd')} UNION ALL
{_agg({'repeated_pairs': _if('k > 1'), 'conflicting_pairs': _if('v > 1'), 'rows_of_repeated_pairs': 'coalesce(sum(k) FILTER (k > 1), 0)::BIGINT'}, 'p')}"""
SQL["most_repeated_pairs"] = _explored("ratings", "u m r t") + "SELECT u, m, count(*) AS n FROM d WHERE ok GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY n DESC, u, m LIMIT 5"
SQL["most_active_users"] = _explored("ratings", "u m r t") + "SELECT u, count(*) AS n FROM d WHERE ok GROUP BY 1 ORDER BY n DESC, u LIMIT 5"
SQL["value_histogram"] = _explored("ratings", "u m r t") + f"SELECT {_number('r')} AS rating, count(*) AS n FROM d WHERE ok GROUP BY 1 HAVING rating IS NOT NULL"
SQL["width_histogram"] = _RAW + "SELECT source_table, len(string_split(raw_record, '::')) AS width, count(*) AS n FROM (SELECT source_table, raw_record FROM raw_users UNION ALL SELECT source_table, raw_record FROM raw_movies UNION ALL SELECT source_table, raw_record FROM raw_ratings) GROUP BY 1, 2"
SQL["bad_value_histogram"] = _RAW + f""", u AS (SELECT * FROM ({_fields('raw_users', 'id g a o z')}) WHERE width = 5), m AS (SELECT unnest(string_split(g, '|')) AS x FROM ({_fields('raw_movies', 'id t g')}) WHERE width = 3 AND trim(g) <> ''), r AS (SELECT * FROM ({_fields('raw_ratings', 'u m r t')}) WHERE width = 4), b AS (
SELECT 'users' AS source_table, 'gender' AS field, left(g, 12) AS value FROM u WHERE g NOT IN ('F', 'M') UNION ALL SELECT 'users', 'age', left(a, 12) FROM u WHERE NOT {_in('a', AGES)} UNION ALL
SELECT 'users', 'occupation', left(o, 12) FROM u WHERE NOT {_in('o', _LEGAL)} UNION ALL SELECT 'users', 'zip', left(z, 10) FROM u WHERE NOT {_full('z', '[0-9]{5}(-[0-9]{4})?')} UNION ALL
SELECT 'movies', 'genre', left(x, 16) FROM m WHERE NOT {_in('x', GENRES)} UNION ALL SELECT 'ratings', 'rating', left(r, 8) FROM r WHERE NOT {_full('r', '[1-5]')})
SELECT source_table, field, value, count(*) AS n FROM b GROUP BY 1, 2, 3"""
SQL["summary_gates"] = _SEEN + f"""SELECT 'six_tables' AS gate, abs(count(*) - 6)::BIGINT AS violations FROM cnt UNION ALL
SELECT 'within_records', {_if('greatest(acc, cons, ud, uniq_excess) > n OR least(' + _CNT + ') < 0')} FROM cnt UNION ALL
SELECT 'splits_conserve', {_if("phase = 'after' AND source_table = 'ratings' AND train + valid + test <> n")} FROM cnt UNION ALL
SELECT 'clean_is_unique', {_if("phase = 'after' AND uniq_excess <> 0")} FROM cnt"""
SQL["event_gates"] = _CLEAN + f"""SELECT 'order_complete' AS gate, {_if('low <> 0 OR high <> n - 1 OR k <> n')} AS violations FROM (SELECT min(event_order) AS low, max(event_order) AS high, count(DISTINCT event_order) AS k, count(*) AS n FROM ev GROUP BY source_id) UNION ALL
SELECT 'kept_without_end', {_if("disposition = 'KEEP' AND action IN ('isolate', 'dedup')")} FROM ev UNION ALL
SELECT 'keep_rewrites', {_if("action = 'keep' AND before IS DISTINCT FROM after")} FROM ev UNION ALL
SELECT 'target_elsewhere', {_if("(action = 'dedup') <> coalesce(target <> source_id, false)")} FROM ev"""


def _typed(of: str, columns: str) -> str:
    return _CLEAN + _REL + f"SELECT source_id, source_table, source_offset, {columns}, coalesce(related, '') AS related FROM {of} LEFT JOIN rel ON winner = source_id WHERE disposition = 'KEEP'"


_YEAR = f"try_cast(nullif(regexp_extract({_P[1]}, '[(]([0-9]{{4}})[)]\\s*$', 1), '') AS INT)"
SQL["typed_users"] = _typed("cu", f"{_P[0]} AS user_id, {_P[1]} AS gender, CAST({_P[2]} AS INT) AS age, CAST({_P[3]} AS INT) AS occupation, {_P[4]} AS zip_code")
SQL["typed_movies"] = _typed("cm", f"{_P[0]} AS movie_id, {_P[1]} AS title, CASE WHEN {_YEAR} <= {LAST_YEAR} THEN {_YEAR} END AS year, {_P[2]} AS genres")
SQL["typed_ratings"] = _typed("cr", f"{_P[0]} AS user_id, {_P[1]} AS movie_id, CAST({_P[2]} AS TINYINT) AS rating, CAST({_P[3]} AS BIGINT) AS timestamp_seconds")
SQL["official_counts"] = _RAW + """SELECT source_table, official::BIGINT AS official, n, n - official AS surplus FROM (SELECT 'users' AS source_table, 6040 AS official, (SELECT count(*) FROM customer) AS n UNION ALL
SELECT 'movies', 3883, (SELECT count(*) FROM part) UNION ALL SELECT 'ratings', 1000209, (SELECT count(*) FROM events))"""
SQL["explore_samples"] = _RAW + f""", u AS (SELECT *, {_complete('id g a o z')} AS ok FROM ({_fields('raw_users', 'id g a o z')})), m AS (SELECT *, {_complete('id t g')} AS ok FROM ({_fields('raw_movies', 'id t g')})), r AS (SELECT *, {_complete('u m r t')} AS ok, {_number('r')} AS rv FROM ({_fields('raw_ratings', 'u m r t')})),
o AS (SELECT 'users' AS source_table, 'incomplete' AS kind, source_offset, raw_record FROM u WHERE NOT ok UNION ALL SELECT 'users', 'bad_gender', source_offset, raw_record FROM u WHERE ok AND g NOT IN ('F', 'M')
UNION ALL SELECT 'users', 'bad_zip', source_offset, raw_record FROM u WHERE ok AND NOT {_full('z', '[0-9]{5}')} UNION ALL SELECT 'movies', 'incomplete', source_offset, raw_record FROM m WHERE NOT ok
UNION ALL SELECT 'movies', 'padded_title', source_offset, raw_record FROM m WHERE ok AND {_trim('t')} <> t UNION ALL SELECT 'movies', 'no_year', source_offset, raw_record FROM m WHERE ok AND NOT regexp_matches(t, {_YEAR_END})
UNION ALL SELECT 'ratings', 'incomplete', source_offset, raw_record FROM r WHERE NOT ok UNION ALL SELECT 'ratings', 'no_integer', source_offset, raw_record FROM r WHERE ok AND rv IS NULL
UNION ALL SELECT 'ratings', 'outside_1_5', source_offset, raw_record FROM r WHERE ok AND (rv < 1 OR rv > 5) UNION ALL SELECT 'ratings', 'no_time', source_offset, raw_record FROM r WHERE ok AND NOT {_full('t', '[0-9]+')})
SELECT source_table, kind, source_offset, raw_record, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY source_table, kind ORDER BY source_offset) AS place FROM o) WHERE place <= 3"""
SQL["unknown_references"] = _RAW + f""", u AS (SELECT DISTINCT id FROM ({_fields('raw_users', 'id g a o z')}) WHERE {_complete('id g a o z')}), m AS (SELECT DISTINCT id FROM ({_fields('raw_movies', 'id t g')}) WHERE {_complete('id t g')}), r AS (SELECT * FROM ({_fields('raw_ratings', 'u m r t')}) WHERE {_complete('u m r t')})
SELECT DISTINCT 'user' AS kind, u AS id FROM r WHERE u NOT IN (SELECT id FROM u) UNION ALL SELECT DISTINCT 'movie', m FROM r WHERE m NOT IN (SELECT id FROM m)"""
