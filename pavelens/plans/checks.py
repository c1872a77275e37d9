"""SQL that says the general data problems a second time, for the check of their queries.

Nothing of the operators is used here: time stamps are read format by format with the zone rule of the European Union
written out, geometries are taken apart with regular expressions, and pairs are tested by crossings of their edges.
"""

from __future__ import annotations

_TIME = r"(\d{1,2}):(\d{2}):(\d{2})(?:[.,](\d+))?\s*(AM|PM)?"
_ZONE = r"\s*(Z|UTC|GMT|MESZ|MEZ|CEST|CET|(?:UTC|GMT)?[+-]\d{2}(?::?\d{2})?)?\s*(?:\[([A-Z0-9_+/-]+)\])?$"
_FIELDS = "['a','b','c','h','mi','s','f','ap','z','br']"


def _edge() -> str:
    """Blanks and quotes as an SQL string."""
    codes = [9, 10, 11, 12, 13, 32, 34, 39, 96, 0xA0, 0x2007, 0x202F, 0xFEFF, 0x201C, 0x201D, 0x201E, 0x2018, 0x2019, 0x201A, 0xAB, 0xBB]
    return " || ".join(f"chr({c})" for c in codes)


def instants() -> str:
    """CTEs that end in ts(time_stamp, utc_us): every time stamp that states one instant."""
    date = r"^(\d{1,2})\%s(\d{1,2})\%s(\d{4})[ T,]\s*"
    months = "['JAN','FEB','MAR','APR','MAY','JUN','JUL','AUG','SEP','OCT','NOV','DEC']"
    names = {
        "iso": (rf"^(\d{{4}})-(\d{{2}})-(\d{{2}})[T ]{_TIME}{_ZONE}", _FIELDS, "g.a", "g.b", "g.c"),
        "basic": (rf"^(\d{{4}})(\d{{2}})(\d{{2}})T(\d{{2}})(\d{{2}})(\d{{2}})(?:[.,](\d+))?(){_ZONE}", _FIELDS, "g.a", "g.b", "g.c"),
        "mail": (rf"^(?:[A-Z]{{3}},?\s+)?(\d{{1,2}})\s+([A-Z]{{3}})\s+(\d{{4}})\s+{_TIME}{_ZONE}", _FIELDS, "g.c", f"CAST(list_position({months}, g.b) AS VARCHAR)", "g.a"),
        "dotted": ((date % (".", ".")) + _TIME + _ZONE, _FIELDS, "g.c", "g.b", "g.a"),
        "slashed": ((date % ("/", "/")) + _TIME + _ZONE, _FIELDS, "g.c", "g.a", "g.b"),
    }
    each = " UNION ALL ".join(
        f"""SELECT time_stamp, {y} AS y, {m} AS m, {d} AS d, g.h, g.mi, g.s, g.f, g.ap, g.z, g.br FROM (SELECT time_stamp, regexp_extract(t, '{rx}',
 {fields}) AS g FROM tx WHERE regexp_matches(t, '{rx}'))"""
        for rx, fields, y, m, d in names.values()
    )
    sunday = lambda month: f"(make_date(yy, {month}, 31) - CAST(isodow(make_date(yy, {month}, 31)) % 7 AS INTEGER))"
    at = lambda month, hour: f"(epoch_us(CAST({sunday(month)} AS TIMESTAMP)) + CAST({hour} AS BIGINT) * 3600000000)"
    return f"""tx AS (SELECT DISTINCT time_stamp, upper(trim(time_stamp, {_edge()})) AS t FROM recordings WHERE time_stamp IS NOT NULL),
 p0 AS ({each}),
 p1 AS (SELECT time_stamp, z, br, f, TRY_CAST(y AS INTEGER) AS yy, lpad(y, 4, '0') || '-' || lpad(m, 2, '0') || '-' || lpad(d, 2, '0') AS day,
 CAST(mi AS INTEGER) AS mi, CAST(s AS INTEGER) AS s,
  CASE WHEN ap = '' THEN CAST(h AS INTEGER) WHEN CAST(h AS INTEGER) BETWEEN 1 AND 12 THEN CAST(h AS INTEGER) % 12 + CASE WHEN ap = 'PM' THEN 12
 ELSE 0 END END AS h FROM p0),
 p2 AS (SELECT *, CASE WHEN h < 24 AND mi < 60 AND s < 60
 THEN epoch_us(TRY_CAST(day AS TIMESTAMP)) + CAST(h * 3600 + mi * 60 + s AS BIGINT) * 1000000 + CAST(rpad(substr(f, 1, 6), 6, '0') AS BIGINT) END AS w,
  regexp_extract(z, '[+-][0-9]{{2}}:?[0-9]{{0,2}}$') AS off FROM p1),
 p3 AS (SELECT *, CASE WHEN off <> '' THEN CASE WHEN CAST(substr(off, 2, 2) AS INTEGER) <= 18 AND coalesce(TRY_CAST(substr(replace(off, ':', ''), 4,
 2) AS INTEGER), 0) < 60
    THEN (CASE WHEN off[1] = '-' THEN -1 ELSE 1 END) * (CAST(substr(off, 2, 2) AS INTEGER) * 60 + coalesce(TRY_CAST(substr(replace(off, ':', ''), 4,
 2) AS INTEGER), 0)) END
  WHEN z IN ('MEZ', 'CET') THEN 60 WHEN z IN ('MESZ', 'CEST') THEN 120 WHEN z IN ('Z', 'UTC', 'GMT') THEN 0
  WHEN br IN ('UTC', 'Z', 'GMT', 'ETC/UTC') THEN 0
  WHEN br IN ('', 'EUROPE/BERLIN') THEN CASE WHEN w >= {at(3, 3)} AND w < {at(10, 2)} THEN 120 WHEN w < {at(3, 2)} OR w >= {at(10, 3)}
 THEN 60 END END AS minutes FROM p2 WHERE w IS NOT NULL),
 n0 AS (SELECT time_stamp, regexp_extract(t, '^(\\d{{1,19}})(?:\\.(\\d+))?$', ['i', 'f']) AS g FROM tx WHERE regexp_matches(t, '^\\d{{1,19}}(\\.\\d+)?$')),
 n1 AS (SELECT time_stamp, unnest([1000000000000, 1000000000, 1000000, 1000]) AS unit, CAST(g.i AS HUGEINT) AS i, CAST(rpad(substr(g.f, 1, 6), 6,
 '0') AS HUGEINT) AS f FROM n0),
 n2 AS (SELECT time_stamp, (i * unit + f * unit // 1000000) // 1000000 AS us FROM n1),
 ts AS (SELECT time_stamp, w - CAST(minutes AS BIGINT) * 60000000 AS utc_us FROM p3 WHERE minutes IS NOT NULL
  UNION ALL SELECT time_stamp, CAST(us AS BIGINT) FROM n2 WHERE us >= epoch_us(TIMESTAMP '2021-01-01') AND us < epoch_us(TIMESTAMP '2028-01-01'))"""


def shapes(name: str, table: str, key: str) -> str:
    """CTEs name_e(id, k, x, y, u, v), the edges of each different geometry k of an id, and name_b, its bounding box."""
    number = r"([-+0-9.eE]+)\s+([-+0-9.eE]+)"
    return rf"""{name}_g AS (SELECT row_number() OVER () AS k, id, g FROM (SELECT DISTINCT {key} AS id, geometry AS g FROM {table}
 WHERE geometry IS NOT NULL AND {key} IS NOT NULL)),
 {name}_r AS (SELECT k, id, row_number() OVER () AS r, ring FROM (SELECT k, id, unnest(regexp_extract_all(g, '\(([^()]+)\)', 1)) AS ring FROM {name}_g)),
 {name}_p AS (SELECT k, id, r, i, CAST(regexp_extract(p, '{number}', 1) AS DOUBLE) AS x, CAST(regexp_extract(p, '{number}', 2) AS DOUBLE) AS y
 FROM (SELECT k, id, r, unnest(string_split(ring, ',')) AS p, generate_subscripts(string_split(ring, ','), 1) AS i FROM {name}_r)),
 {name}_e AS (SELECT k, id, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS u, coalesce(lead(y) OVER w, first_value(y) OVER w) AS v
 FROM {name}_p WINDOW w AS (PARTITION BY k, r ORDER BY i)),
 {name}_b AS (SELECT k, id, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM {name}_p GROUP BY k, id)"""


def _inside(points: str, edges: str) -> str:
    """For rows (p, k) of a point table with x, y and an edge table of k: whether the crossings of a ray to the right are odd."""
    return f"""SELECT q.p, q.k, count(*) FILTER (WHERE (e.y > q.y) <> (e.v > q.y) AND q.x < (e.u - e.x) * (q.y - e.y) / nullif(e.v - e.y,
 0) + e.x) % 2 = 1 AS inn FROM {points} q JOIN {edges} e ON e.k = q.k GROUP BY q.p, q.k"""


_SIDE = "((({2}) - ({0})) * (({5}) - ({1})) - (({3}) - ({1})) * (({4}) - ({0})))"


def near_and_inside() -> str:
    """The three relations of the spatial query."""
    number = r"([-+0-9.eE]+)\s+([-+0-9.eE]+)"
    side = lambda *a: _SIDE.format(*a)
    cross = f"{side('s.x', 's.y', 's.u', 's.v', 'e.x', 'e.y')} * {side('s.x', 's.y', 's.u', 's.v', 'e.u', 'e.v')} < 0 AND {side('e.x', 'e.y', 'e.u', 'e.v', 's.x', 's.y')} * {side('e.x', 'e.y', 'e.u', 'e.v', 's.u', 's.v')} < 0"
    return rf"""WITH {shapes('ar', 'strassenzustand', 'area_id')}, {shapes('su', 'substance', 'substance_id')},
 rc AS (SELECT row_number() OVER () AS p, * FROM (SELECT DISTINCT rec_id, run_id, CAST(regexp_extract(geometry, '{number}', 1) AS DOUBLE) AS x,
 CAST(regexp_extract(geometry, '{number}', 2) AS DOUBLE) AS y FROM recordings WHERE regexp_matches(geometry, '{number}') AND rec_id IS NOT NULL)),
 nr AS (SELECT *, floor(x / 2.5) AS cx, floor(y / 2.5) AS cy FROM rc WHERE run_id IS NOT NULL),
 n9 AS (SELECT rec_id, run_id, x, y, cx + dx AS cx, cy + dy AS cy FROM nr, (VALUES (-1), (0), (1)) a(dx), (VALUES (-1), (0), (1)) b(dy)),
 near AS (SELECT DISTINCT 'rec_rec' AS relation, a.rec_id AS a_id, b.rec_id AS b_id FROM nr a JOIN n9 b ON a.cx = b.cx AND a.cy = b.cy
 WHERE a.rec_id < b.rec_id AND a.run_id <> b.run_id AND (a.x - b.x) ^ 2 + (a.y - b.y) ^ 2 <= 6.25),
 rq AS (SELECT rc.p, b.k, rc.x, rc.y FROM rc JOIN ar_b b ON rc.x > b.x0 AND rc.x < b.x1 AND rc.y > b.y0 AND rc.y < b.y1),
 ri AS ({_inside('rq', 'ar_e')}),
 points AS (SELECT DISTINCT 'rec_area' AS relation, rc.rec_id AS a_id, b.id AS b_id FROM ri JOIN rc ON rc.p = ri.p JOIN ar_b b ON b.k = ri.k WHERE inn),
 sc AS (SELECT s.k AS sk, a.k AS k FROM su_b s JOIN ar_b a ON s.x0 >= a.x0 AND s.x1 <= a.x1 AND s.y0 >= a.y0 AND s.y1 <= a.y1),
 sv AS (SELECT row_number() OVER () AS p, sc.sk, sc.k, e.x, e.y FROM sc JOIN su_e e ON e.k = sc.sk),
 si AS ({_inside('sv', 'ar_e')}),
 ok AS (SELECT sv.sk, sv.k FROM sv JOIN si ON si.p = sv.p AND si.k = sv.k GROUP BY sv.sk, sv.k HAVING bool_and(inn)),
 cr AS (SELECT DISTINCT ok.sk, ok.k FROM ok JOIN su_e s ON s.k = ok.sk JOIN ar_e e ON e.k = ok.k WHERE {cross}),
 av AS (SELECT row_number() OVER () AS p, ok.sk AS k, ok.k AS ak, e.x, e.y FROM ok JOIN ar_e e ON e.k = ok.k),
 ai AS ({_inside('av', 'su_e')}),
 ho AS (SELECT DISTINCT av.k AS sk, av.ak AS k FROM av JOIN ai ON ai.p = av.p AND ai.k = av.k WHERE inn),
 whole AS (SELECT DISTINCT 'sub_area' AS relation, s.id AS a_id, a.id AS b_id FROM (SELECT * FROM ok EXCEPT SELECT * FROM cr EXCEPT SELECT *
 FROM ho) o JOIN su_b s ON s.k = o.sk JOIN ar_b a ON a.k = o.k)
 SELECT * FROM near UNION ALL SELECT * FROM points UNION ALL SELECT * FROM whole"""


def records_once() -> str:
    """Every id that stands in a complete JSON line of a payload."""
    return r"""WITH l AS (SELECT table_name, trim(unnest(string_split(payload, chr(10))), chr(13) || chr(9) || ' ') AS line FROM cache_files WHERE payload IS NOT NULL),
 j AS (SELECT table_name, line FROM l WHERE line[1] = '{' AND line[-1] = '}' AND json_valid(line)),
 k AS (SELECT table_name, TRY_CAST(json_extract_string(line, CASE table_name WHEN 'Substance' THEN '$.substance_id' WHEN 'Strassenzustand'
 THEN '$.area_id' ELSE '$.none' END) AS BIGINT) AS record_id FROM j)
 SELECT DISTINCT table_name, record_id FROM k WHERE record_id IS NOT NULL"""


SQL = {
    "p3_found": near_and_inside(),
    "p4_found": "WITH " + instants() + " SELECT DISTINCT rec_id, utc_us FROM recordings JOIN ts USING (time_stamp)",
    "p5_found": records_once(),
}
