"""The same results in DuckDB SQL, written independently of the Spark operators.

Each oracle is one statement: the tables it needs, as a chain of common table expressions, and a
final projection that brings times, distances and positions to comparable precision.
"""

from __future__ import annotations

from dwellmap.checks.fixtures import STATE_CELLS, ZONE_CELLS, _values

# Fixed value: twice the radius of the sphere, in metres.
_R2 = f"{2 * 6372.795 * 1000}::DOUBLE"


def _hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"({_R2} * asin(sqrt(pow(sin(({lat2} - {lat1}) / 2), 2) "
        f"+ cos({lat1}) * cos({lat2}) * pow(sin(({lon2} - {lon1}) / 2), 2))))"
    )


def _geohash(lat: str, lon: str, length: int) -> str:
    """Geohash by integer scaling; position k of the string takes bits 5k to 5k+4."""
    n = 5 * length
    nlon, nlat = (n + 1) // 2, n // 2
    lo = f"CAST(floor(({lon} + 180.0) / 360.0 * {2**nlon}) AS BIGINT)"
    la = f"CAST(floor(({lat} + 90.0) / 180.0 * {2**nlat}) AS BIGINT)"
    text = []
    for k in range(length):
        terms = []
        for b in range(5):
            i = 5 * k + b
            value, shift = (lo, nlon - 1 - i // 2) if i % 2 == 0 else (la, nlat - 1 - i // 2)
            terms.append(f"{2 ** (4 - b)} * (({value} // {2**shift}) % 2)")
        text.append(f"substring('0123456789bcdefghjkmnpqrstuvwxyz', CAST(1 + {' + '.join(terms)} AS INT), 1)")
    return "(" + " || ".join(text) + ")"


# Each entry: the tables it reads, and its definition.
_CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "pings": (
        (),
        """
        SELECT event_id, k,
          ts + to_seconds(CAST(k * 150 AS BIGINT)) AS t,
          lower(lpad(to_hex((user_id * 2654435761) % 4294967296), 8, '0')) AS userId,
          CAST(1 AS TINYINT) AS device,
          CAST(40.0 AS DOUBLE) + (user_id % 15) * CAST(0.01 AS DOUBLE) + place * CAST(0.005 AS DOUBLE)
            + (event_id % 5) * CAST(0.00005 AS DOUBLE)
            + k * CAST(CASE event_type WHEN 'error' THEN 0.002 WHEN 'signup' THEN 0.0003
                       WHEN 'purchase' THEN 0.0005 ELSE 0.00002 END AS DOUBLE) AS latitude,
          CAST(-75.0 AS DOUBLE) - (user_id % 10) * CAST(0.02 AS DOUBLE) AS longitude,
          CAST((event_id * 37 + k * 11) % 110 - 5 AS DOUBLE) AS accuracy,
          CAST(-18000 AS INT) AS utc_offset,
          CASE WHEN place = 0 THEN 'PERSONAL_AREA' ELSE 'OTHER' END AS opt1,
          CAST(ts AS DATE) + CAST(event_id % 4 AS INT) AS delivery_day
        FROM (SELECT *, unnest(range(6)) AS k FROM
               (SELECT *, (user_id * 7 + CAST(floor(epoch(ts) / 43200) AS BIGINT)) % 3 AS place FROM events))
        """,
    ),
    "raw": (
        ("pings",),
        """
        SELECT CAST(CAST(floor(epoch(t)) AS BIGINT) - CASE WHEN kind = 'stale' THEN 3456000 ELSE 0 END AS VARCHAR) AS c0,
          userId AS c1, '1' AS c2, printf('%.6f', latitude) AS c3, printf('%.6f', longitude) AS c4,
          CASE kind WHEN 'malformed' THEN 'x' WHEN 'inaccurate' THEN '300.9'
               ELSE CAST(CAST(accuracy AS INT) AS VARCHAR) END AS c5,
          '-18000' AS c6, opt1 AS c7, CAST(NULL AS VARCHAR) AS c8, delivery_day
        FROM (SELECT *, 'good' AS kind FROM pings
              UNION ALL SELECT *, 'malformed' FROM pings WHERE k = 0 AND event_id % 10 = 3
              UNION ALL SELECT *, 'inaccurate' FROM pings WHERE k = 0 AND event_id % 10 = 5
              UNION ALL SELECT *, 'stale' FROM pings WHERE k = 0 AND event_id % 10 = 7)
        """,
    ),
    "typed": (
        ("raw",),
        """
        SELECT make_timestamp(TRY_CAST(c0 AS BIGINT) * 1000000) AS t, c1 AS userId, TRY_CAST(c2 AS TINYINT) AS device,
          TRY_CAST(c3 AS DOUBLE) AS latitude, TRY_CAST(c4 AS DOUBLE) AS longitude,
          TRY_CAST(c5 AS DOUBLE) AS accuracy, TRY_CAST(c6 AS INT) AS utc_offset, c7 AS opt1, c8 AS opt2,
          'pings_US_' || strftime(delivery_day, '%Y%m%d') AS source, delivery_day,
          (TRY_CAST(c5 AS DOUBLE) <= 300 AND TRY_CAST(c0 AS BIGINT)
             BETWEEN epoch(delivery_day) - 30 * 86400 AND epoch(delivery_day) + 86400) IS TRUE AS kept
        FROM raw
        """,
    ),
    "delivered": (
        ("pings",),
        """
        SELECT * FROM pings
        UNION ALL SELECT * REPLACE (delivery_day + 1 AS delivery_day, 'LATE' AS opt1)
          FROM pings WHERE event_id % 10 = 0
        UNION ALL SELECT * REPLACE (CAST(t AS DATE) + 31 AS delivery_day, 'TOO_LATE' AS opt1)
          FROM pings WHERE event_id % 50 = 0
        """,
    ),
    "consolidated": (
        ("delivered",),
        """
        SELECT arg_min(opt1, delivery_day) AS opt1, arg_min(latitude, delivery_day) AS latitude,
          arg_min(longitude, delivery_day) AS longitude, t, userId, accuracy
        FROM delivered
        WHERE delivery_day >= CAST(t AS DATE) - 1 AND delivery_day <= CAST(t AS DATE) + 30
        GROUP BY t, userId, accuracy
        """,
    ),
    "accurate": (
        ("pings",),
        "SELECT *, opt1 = 'PERSONAL_AREA' AS personal FROM pings WHERE accuracy >= 0 AND accuracy <= 70",
    ),
    "thinned": (
        ("accurate",),
        """
        SELECT * FROM accurate
        QUALIFY row_number() OVER (PARTITION BY userId, CAST(floor(epoch(t)) AS BIGINT) // 60
                                   ORDER BY accuracy, t, latitude, longitude) = 1
        """,
    ),
    "expanded": (
        ("thinned",),
        """
        SELECT *, CAST(t AS DATE) AS d FROM thinned
        UNION ALL SELECT *, CAST(t AS DATE) - 1 FROM thinned WHERE hour(t) < 6
        """,
    ),
    "steps": (
        ("expanded",),
        f"""
        SELECT *, coalesce(lag(distance_next) OVER (PARTITION BY d, userId ORDER BY t), 0) AS distance_prev
        FROM (SELECT *, {_hav('la', 'lo', 'lead(la) OVER w', 'lead(lo) OVER w')} AS distance_next
              FROM (SELECT *, radians(latitude) AS la, radians(longitude) AS lo FROM expanded)
              WINDOW w AS (PARTITION BY d, userId ORDER BY t))
        """,
    ),
    "chunked": (
        ("steps",),
        """
        SELECT *, CAST(sum(CASE WHEN distance_prev > 70 THEN 1 ELSE 0 END)
                       OVER (PARTITION BY d, userId ORDER BY t) AS INT) AS chunk
        FROM steps
        """,
    ),
    "daily": (
        ("chunked",),
        """
        SELECT * FROM (SELECT *, min(t) OVER (PARTITION BY d, userId, chunk) AS chunk_start FROM chunked)
        WHERE CAST(chunk_start AS DATE) = d
        """,
    ),
    "numbered": (
        ("daily",),
        """
        SELECT *, row_number() OVER (PARTITION BY d, userId, chunk ORDER BY t) - 1 AS i,
               count(*) OVER (PARTITION BY d, userId, chunk) AS n
        FROM daily
        """,
    ),
    # For each ping: the first later ping out of reach, and the first one at least five minutes on.
    "ahead": (
        ("numbered",),
        f"""
        SELECT d, userId, chunk, i, min(j) FILTER (WHERE far) AS first_far, min(j) FILTER (WHERE late) AS js
        FROM (SELECT a.d, a.userId, a.chunk, a.i, b.i AS j,
                {_hav('a.la', 'a.lo', 'b.la', 'b.lo')} > 70 AS far,
                b.t >= a.t + INTERVAL 5 MINUTE AS late
              FROM numbered a JOIN numbered b
                ON a.d = b.d AND a.userId = b.userId AND a.chunk = b.chunk AND a.i < b.i)
        GROUP BY ALL
        """,
    ),
    "spots": (
        ("numbered", "ahead"),
        """
        SELECT *, coalesce(en >= js, false) AS is_stop, CASE WHEN en >= js THEN en + 1 ELSE i + 1 END AS nxt
        FROM (SELECT p.*, a.js, CAST(p.d + 1 AS TIMESTAMP) AS midnight,
                coalesce(min(a.first_far) OVER (PARTITION BY p.d, p.userId, p.chunk ORDER BY p.i
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), p.n) - 1 AS en
              FROM numbered p LEFT JOIN ahead a
                ON p.d = a.d AND p.userId = a.userId AND p.chunk = a.chunk AND p.i = a.i)
        """,
    ),
    "walk(d, userId, chunk, i, seen)": (
        ("spots",),
        """
        SELECT d, userId, chunk, i, 0 FROM spots WHERE i = 0 AND n >= 2
        UNION ALL
        SELECT w.d, w.userId, w.chunk, s.nxt, w.seen + CASE WHEN s.is_stop THEN 1 ELSE 0 END
        FROM walk w JOIN spots s ON w.d = s.d AND w.userId = s.userId AND w.chunk = s.chunk AND w.i = s.i
        WHERE s.js IS NOT NULL AND s.nxt < s.n AND NOT (s.is_stop AND s.t > s.midnight AND w.seen > 0)
        """,
    ),
    "visited": (
        ("walk(d, userId, chunk, i, seen)", "spots"),
        """
        SELECT s.*, w.seen, s.is_stop AND s.t > s.midnight AND w.seen > 0 AS is_marker
        FROM walk w JOIN spots s ON w.d = s.d AND w.userId = s.userId AND w.chunk = s.chunk AND w.i = s.i
        """,
    ),
    "legs": (
        ("visited",),
        """
        SELECT d, userId, chunk, seen, sum(CASE WHEN t < midnight THEN distance_prev ELSE 0 END) AS walked,
               bool_or(is_marker) AS marked
        FROM visited GROUP BY ALL
        """,
    ),
    "found": (
        ("visited", "legs", "numbered"),
        """
        SELECT v.d, v.userId, v.chunk, v.seen AS serial, avg(m.la) AS la, avg(m.lo) AS lo,
          min(m.t) AS b, max(m.t) AS e, bool_or(m.personal) AS personal, any_value(l.walked) AS distance,
          any_value(CASE WHEN v.seen + 1 < v.total THEN 0 WHEN a.marked THEN 0.1 ELSE coalesce(a.walked, 0) END)
            AS after_stop_distance
        FROM (SELECT *, count(*) OVER (PARTITION BY d, userId, chunk) AS total
              FROM visited WHERE is_stop AND NOT is_marker) v
        JOIN numbered m ON m.d = v.d AND m.userId = v.userId AND m.chunk = v.chunk AND m.i BETWEEN v.i AND v.en
        JOIN legs l ON l.d = v.d AND l.userId = v.userId AND l.chunk = v.chunk AND l.seen = v.seen
        LEFT JOIN legs a ON a.d = v.d AND a.userId = v.userId AND a.chunk = v.chunk AND a.seen = v.seen + 1
        GROUP BY v.d, v.userId, v.chunk, v.seen
        """,
    ),
    "detected": (
        ("daily", "found"),
        f"""
        SELECT c.d, c.userId, c.chunk, f.serial, f.la, f.lo, f.b, f.e, f.personal, f.distance,
          CASE WHEN f.serial IS NOT NULL THEN {_geohash('degrees(f.la)', 'degrees(f.lo)', 6)} END AS geohash6,
          f.after_stop_distance, c.dist_sum
        FROM (SELECT d, userId, chunk, sum(distance_prev) AS dist_sum FROM daily GROUP BY ALL) c
        LEFT JOIN found f ON c.d = f.d AND c.userId = f.userId AND c.chunk = f.chunk
        """,
    ),
    "travelled": (
        ("detected",),
        """
        SELECT * FROM (
          SELECT *, coalesce(lead(prev_td) OVER (PARTITION BY d, userId ORDER BY left_over DESC),
                             CASE WHEN after_sd > 0 THEN after_sd END) AS next_td
          FROM (SELECT d, userId, left_over, max(degrees(la)) AS latitude, max(degrees(lo)) AS longitude,
                  max(b) AS b, max(e) AS e, bool_or(personal) AS personal, max(geohash6) AS geohash6,
                  sum(CASE WHEN serial IS NULL THEN dist_sum ELSE distance END) AS prev_td,
                  sum(coalesce(after_stop_distance, 0)) AS after_sd
                FROM (SELECT *, count(serial) OVER (PARTITION BY d, userId ORDER BY chunk, serial NULLS FIRST
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_over
                      FROM detected WHERE b IS NULL OR CAST(b AS DATE) <> d + 1)
                GROUP BY d, userId, left_over))
        WHERE latitude IS NOT NULL
        """,
    ),
    "states": (
        (),
        f"""
        SELECT geohash5, min(state) AS state FROM (VALUES {_values(STATE_CELLS)}) s(state, geohash5)
        GROUP BY geohash5
        """,
    ),
    "zones": ((), f"SELECT * FROM (VALUES {_values(ZONE_CELLS)}) z(tzid, geohash5)"),
    "stops": (
        ("travelled", "states"),
        "SELECT t.*, s.state FROM travelled t JOIN states s ON s.geohash5 = left(t.geohash6, 5)",
    ),
    "hours": (
        ("accurate",),
        """
        SELECT userId, CAST(count(DISTINCT hour(t)) AS INT) AS num_hours, left(userId, 2) AS prefix,
          CAST(year(CAST(t AS DATE)) AS INT) AS year, CAST(dayofyear(CAST(t AS DATE)) AS INT) AS dayofyear
        FROM accurate GROUP BY userId, CAST(t AS DATE)
        """,
    ),
}


def _flagged(day_rule: str, source: str = "stops") -> str:
    return f"""
        SELECT *, CASE WHEN ((pn <> prev_td) OR prev_td > 0 OR pn > 0 OR jump > 70
                    OR (dayofyear(b) - dayofyear(pe) {day_rule} AND hour(b) < 6))
                   AND (pe IS NULL OR pe < b) THEN 1 ELSE 0 END AS opens
        FROM (SELECT *, coalesce({_hav('pla', 'plo', 'radians(latitude)', 'radians(longitude)')}, 0) AS jump
              FROM (SELECT *, lag(coalesce(next_td, 0)) OVER w AS pn, lag(e) OVER w AS pe,
                      lag(radians(latitude)) OVER w AS pla, lag(radians(longitude)) OVER w AS plo
                    FROM {source} WINDOW w AS (PARTITION BY userId ORDER BY b, e, latitude, longitude)))
        """


def _merged(flagged: str, by_state: bool) -> str:
    state = "state" if by_state else "first(state ORDER BY b, e, latitude, longitude, state) AS state"
    return f"""
        SELECT userId, {state}, avg(latitude) AS latitude, avg(longitude) AS longitude, min(b) AS b, max(e) AS e
        FROM (SELECT *, sum(opens) OVER (PARTITION BY userId ORDER BY b) AS grp FROM {flagged})
        GROUP BY userId, grp{', state' if by_state else ''}
        """


_REPAIRED = """
    SELECT * REPLACE (CASE WHEN epoch(nb) - epoch(b) > 600 AND nb < e
                      THEN nb - INTERVAL 300 SECOND ELSE e END AS e)
    FROM (SELECT *, lead(b) OVER (PARTITION BY userId ORDER BY b, e, latitude, longitude) AS nb FROM {})
    """

_CTE.update(
    {
        "border_stops": (
            (),
            """
            SELECT printf('user%02d', event_id % 50) AS userId, CASE WHEN n % 3 = 0 THEN 'NJ' ELSE 'PA' END AS state,
              CAST(40.0 AS DOUBLE) + (n // 4) % 9 * CAST(0.001 AS DOUBLE) + n % 4 * CAST(0.00001 AS DOUBLE) AS latitude,
              CAST(-75.0 AS DOUBLE) AS longitude, b,
              b + to_minutes(CAST(CASE WHEN n % 7 = 0 THEN 70 ELSE 4 + n % 3 END AS BIGINT)) AS e,
              CAST(CASE WHEN n % 4 = 0 THEN 30 ELSE 0 END AS DOUBLE) AS prev_td,
              CAST(CASE WHEN (n + 1) % 4 = 0 THEN 30 ELSE 0 END AS DOUBLE) AS next_td
            FROM (SELECT event_id, n, TIMESTAMP '2024-02-01' + to_seconds(CAST(n * 540 + (n * n) % 5 * 60 AS BIGINT)) AS b
                  FROM (SELECT event_id, event_id // 50 AS n FROM events))
            """,
        ),
        "flagged_border": (("border_stops",), _flagged("= 1", "border_stops")),
        "merged_border": (("flagged_border",), _merged("flagged_border", False)),
        "merged_border_state": (("flagged_border",), _merged("flagged_border", True)),
        "repaired_border": (("merged_border",), _REPAIRED.format("merged_border")),
        "flagged": (("stops",), _flagged("= 1")),
        "flagged_v3": (("stops",), _flagged("> 0")),
        "merged": (("flagged",), _merged("flagged", False)),
        "merged_v5": (("flagged",), _merged("flagged", True)),
        "merged_v3": (("flagged_v3",), _merged("flagged_v3", True)),
        "repaired": (("merged",), _REPAIRED.format("merged")),
    }
)


def _cluster_tables(suffix: str, source: str) -> None:
    """Tables for clustering ``source``: reachability closure, labels, centres and local offsets."""
    sites, reach = f"sites{suffix}", f"reach{suffix}"
    head = f"{reach}(userId, state, u, v)"
    _CTE[sites] = (
        (source,),
        f"""
        SELECT *, row_number() OVER (PARTITION BY userId, state ORDER BY b, e, latitude, longitude) AS s,
          radians(latitude) AS la, radians(longitude) AS lo FROM {source}
        """,
    )
    _CTE[f"links{suffix}"] = (
        (sites,),
        f"""
        SELECT a.userId, a.state, a.s AS u, b.s AS v FROM {sites} a JOIN {sites} b
          ON a.userId = b.userId AND a.state = b.state AND {_hav('a.la', 'a.lo', 'b.la', 'b.lo')} <= 65
        """,
    )
    _CTE[head] = (
        (f"links{suffix}",),
        f"""
        SELECT userId, state, u, u FROM links{suffix}
        UNION SELECT r.userId, r.state, r.u, l.v FROM {reach} r JOIN links{suffix} l
          ON r.userId = l.userId AND r.state = l.state AND r.v = l.u
        """,
    )
    _CTE[f"clustered{suffix}"] = (
        (sites, head),
        f"""
        SELECT p.*, CAST(dense_rank() OVER (PARTITION BY p.userId, p.state ORDER BY r.label) - 1 AS INT) AS clusterId
        FROM {sites} p JOIN (SELECT userId, state, u, min(v) AS label FROM {reach} GROUP BY ALL) r
          ON p.userId = r.userId AND p.state = r.state AND p.s = r.u
        """,
    )
    _CTE[f"centres{suffix}"] = (
        (f"clustered{suffix}",),
        f"""
        SELECT userId, clusterId, avg(latitude) AS clat, avg(longitude) AS clon
        FROM clustered{suffix} GROUP BY ALL
        """,
    )
    _CTE[f"located{suffix}"] = (
        (f"clustered{suffix}", f"centres{suffix}", "zones"),
        f"""
        SELECT c.*, g.clat, g.clon, g.geohash7, z.tzid, left(c.userId, 2) AS prefix,
          CAST(year(c.b) AS INT) AS year, CAST(dayofyear(c.b) AS INT) AS dayofyear,
          CAST(trunc((epoch(timezone(z.tzid, timezone('UTC', c.b))) - epoch(c.b)) / 3600) AS INT) AS hours_ahead
        FROM clustered{suffix} c
        JOIN (SELECT *, {_geohash('clat', 'clon', 7)} AS geohash7 FROM centres{suffix}) g
          ON c.userId = g.userId AND c.clusterId = g.clusterId
        JOIN zones z ON z.geohash5 = left(g.geohash7, 5)
        """,
    )


_cluster_tables("", "repaired")
_CTE["located_left"] = (_CTE["located"][0], _CTE["located"][1].replace("JOIN zones", "LEFT JOIN zones"))
_cluster_tables("_v5", "merged_v5")
_cluster_tables("_v3", "merged_v3")


def _needed(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needed(_CTE[name][0], seen)
            seen.append(name)
    return seen


def _query(source: str, *columns: str, tail: str = "", tables: tuple[str, ...] | None = None) -> str:
    """SELECT over a chain of tables. A column reads ``expression AS name`` or ``kind:expression AS name``:

    ``us`` microseconds since 1970, ``deg`` a position, ``m`` a distance, ``day`` a date as text.
    """
    wrap = {
        "us": "epoch_us({})",
        "deg": "round({} + 3e-11::DOUBLE, 9)",
        "m": "round({}, 3)",
        "day": "CAST({} AS VARCHAR)",
    }
    shown = []
    for column in columns:
        kind, _, rest = column.partition(":")
        if kind in wrap:
            expr, _, alias = rest.rpartition(" AS ")
            expr, alias = (expr, alias) if expr else (rest, rest)
            shown.append(f'{wrap[kind].format(expr)} AS "{alias}"')
        else:
            shown.append(column)
    chain = _needed(tables or (source,), [])
    ctes = ",\n".join(f"{name} AS {'' if '(' in name else 'MATERIALIZED '}({_CTE[name][1]})" for name in chain)
    return f"WITH RECURSIVE {ctes}\nSELECT {', '.join(shown)} FROM {source} {tail}"


_PING = ("us:t AS timestamp", "userId", "deg:latitude", "deg:longitude", "accuracy")
_STOP = (
    "day:d AS process_day", "userId", "deg:latitude", "deg:longitude", "us:b AS begin", "us:e AS end",
    "personal AS personal_area", "geohash6", "m:prev_td AS prev_travelled_distance",
    "m:after_sd AS after_stop_distance", "m:next_td AS next_travelled_distance",
)
_MERGED = ("userId", "state", "deg:latitude", "deg:longitude", "us:b AS begin", "us:e AS end")
_VISIT = (
    "prefix", "userId", "clusterId", "us:b AS begin", "us:e AS end", 'hours_ahead AS "offset"', "year", "dayofyear",
)
_PLACE = ("prefix", "userId", "clusterId", "deg:clat AS clusterLatitude", "deg:clon AS clusterLongitude", "geohash7")
_YMD = (
    "CAST(year({0}) AS VARCHAR) AS year", "CAST(month({0}) AS VARCHAR) AS month", "CAST(day({0}) AS VARCHAR) AS day",
)
_T_YMD = tuple(c.format("t") for c in _YMD)
_D_YMD = tuple(c.format("d") for c in _YMD)
_TYPED = (
    *_PING, "device", 'utc_offset AS "offset"', "opt1", "opt2", "source", "CAST(year(t) AS INT) AS year",
    "CAST(month(t) AS INT) AS month", "CAST(day(t) AS INT) AS day", "left(userId, 2) AS prefix", "day:delivery_day",
)
_HOURS = ("userId", "num_hours", "prefix", "year", "dayofyear")
_HOURS_TEXT = (
    "userId", "num_hours", "prefix", "CAST(year AS VARCHAR) AS year", "CAST(dayofyear AS VARCHAR) AS dayofyear",
)
_MEMBERS = """(
    SELECT v.d, v.userId, v.chunk, v.seen AS serial, m.i, m.t, m.la, m.lo, m.latitude, m.longitude
    FROM visited v JOIN numbered m
      ON m.d = v.d AND m.userId = v.userId AND m.chunk = v.chunk AND m.i BETWEEN v.i AND v.en
    WHERE v.is_stop AND NOT v.is_marker)"""
_PAIRS = f"""(
    SELECT a.d, a.userId, a.chunk, a.serial, a.i AS i, b.i AS j, a.latitude, a.longitude,
      {_hav('a.la', 'a.lo', 'b.la', 'b.lo')} AS apart
    FROM {_MEMBERS} a JOIN {_MEMBERS} b
      ON a.d = b.d AND a.userId = b.userId AND a.chunk = b.chunk AND a.serial = b.serial)"""
_STOP_KEY = ("day:d AS process_day", "userId", "chunk", "serial")
_GEOMETRY_TABLES = ("visited", "numbered")

_stops_by_day = _query("stops", *_STOP[1:], "left(userId, 2) AS prefix", "state", *_D_YMD)
_stops_by_day_only = _query("stops", *_STOP[1:], "state", *_D_YMD)
_bin_hours_table = _query("hours", *_HOURS_TEXT)
_clustered = _query("clustered", *_MERGED, "clusterId")

ORACLES: dict[str, str] = {
    "scan_tsv": _query(
        "raw", *[f"c{i} AS _c{i}" for i in range(9)], "day:delivery_day"
    ),
    "scan_partition": _query(
        "pings", *_PING, *_T_YMD, "left(userId, 2) AS prefix", tail="WHERE CAST(t AS DATE) = DATE '2024-01-09'"
    ),
    "scan_date_range": _query(
        "pings", *_PING, *_T_YMD, "left(userId, 2) AS prefix",
        tail="WHERE CAST(t AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
    ),
    "scan_state": _query("stops", *_STOP, "state", tail="WHERE state = 'NJ'"),
    "lookup_states": _query(
        f"(SELECT {_geohash('latitude', 'longitude', 5)} AS geohash5, "
        "CASE WHEN event_id % 2 = 0 THEN 'PA' WHEN latitude < 40.1 THEN 'NJ' ELSE 'NY' END AS state FROM pings)",
        "geohash5", "min(state) AS state", tail="GROUP BY geohash5", tables=("pings",),
    ),
    "ingest_project": _query("typed", *_TYPED),
    "ingest_filter": _query(
        "(SELECT *, 0 AS x FROM raw SEMI JOIN (SELECT DISTINCT c0, c1, c5, delivery_day FROM "
        "(SELECT *, TRY_CAST(c5 AS DOUBLE) <= 300 AND epoch(delivery_day) - CAST(c0 AS BIGINT) "
        "BETWEEN -86400 AND 2592000 AS ok FROM raw) WHERE ok) USING (c0, c1, c5, delivery_day))",
        *[f"c{i} AS _c{i}" for i in range(9)], "day:delivery_day", tables=("raw",),
    ),
    "ingest": _query("typed", *_TYPED, tail="WHERE kept"),
    "ingest_stats": _query(
        "typed", "source AS table_name", "count(*) AS count_line_input",
        "count(*) FILTER (WHERE kept) AS count_line_output", tail="GROUP BY source",
    ),
    "write_delivered": _query(
        "typed", *_PING, "source", *_T_YMD, "left(userId, 2) AS prefix", "day:delivery_day", tail="WHERE kept"
    ),
    "consolidate_deliveries": _query("consolidated", *_PING, "opt1"),
    "pending_partitions": _query(
        "(SELECT CAST(t AS DATE) AS day, left(userId, 2) AS prefix FROM pings "
        "EXCEPT SELECT d, left(userId, 2) FROM stops)",
        "day:day", "prefix", tables=("pings", "stops"),
    ),
    "compact_table": _query("consolidated", *_PING, "opt1", *_T_YMD),
    "compact_stops": _stops_by_day_only,
    "compact_bin_hours": _bin_hours_table,
    "accuracy_filter": _query("accurate", *_PING),
    "personal_area_flag": _query("pings", "us:t AS timestamp", "userId", "opt1 = 'PERSONAL_AREA' AS personal_area"),
    "minute_dedup": _query("thinned", *_PING, "personal AS personal_area"),
    "union_overlap": _query(
        "(SELECT *, CAST(t AS DATE) AS d FROM pings UNION ALL "
        "SELECT *, CAST(t AS DATE) - 1 FROM pings WHERE hour(t) < 6)",
        *_PING, "day:d AS process_day", tables=("pings",),
    ),
    "process_day_expand": _query("expanded", *_PING, "day:d AS process_day"),
    "step_distance": _query(
        "steps", "day:d AS process_day", "userId", "us:t AS timestamp", "m:distance_next", "m:distance_prev"
    ),
    "chunks": _query("chunked", "day:d AS process_day", "userId", "us:t AS timestamp", "chunk"),
    "chunk_day_filter": _query("daily", "day:d AS process_day", "userId", "us:t AS timestamp", "chunk"),
    "trajectories": _query(
        "daily", "day:d AS process_day", "userId", "chunk", "m:sum(distance_prev) AS dist_sum", "count(*) AS n",
        "string_agg(CAST(epoch_us(t) AS VARCHAR), ',' ORDER BY t) AS times", tail="GROUP BY d, userId, chunk",
    ),
    "pairwise_distance": _query(
        _PAIRS, *_STOP_KEY, "count(*) AS n_pairs", "m:sum(apart) AS pair_sum_m",
        tail="WHERE i < j GROUP BY d, userId, chunk, serial", tables=_GEOMETRY_TABLES,
    ),
    "stop_diameter": _query(
        _PAIRS, *_STOP_KEY, "m:max(apart) AS diameter_m", tail="GROUP BY d, userId, chunk, serial",
        tables=_GEOMETRY_TABLES,
    ),
    "stop_medoid": _query(
        f"(SELECT * FROM (SELECT *, min(total) OVER (PARTITION BY d, userId, chunk, serial) AS least FROM "
        f"(SELECT d, userId, chunk, serial, i, latitude, longitude, sum(apart) AS total FROM {_PAIRS} GROUP BY ALL)) "
        "WHERE total <= least + 1e-6 QUALIFY row_number() OVER (PARTITION BY d, userId, chunk, serial ORDER BY i) = 1)",
        *_STOP_KEY, "deg:latitude AS medoid_lat", "deg:longitude AS medoid_lon", tables=_GEOMETRY_TABLES,
    ),
    "detect_stops": _query(
        "detected", *_STOP_KEY, "deg:degrees(la) AS latitude", "deg:degrees(lo) AS longitude", "us:b AS begin",
        "us:e AS end", "personal AS personal_area", "m:distance", "geohash6", "m:after_stop_distance", "m:dist_sum",
    ),
    "travelled_distance": _query("travelled", *_STOP),
    "stops_with_state": _query("stops", *_STOP, "state"),
    "write_stops": _stops_by_day,
    "backfill": _query(
        "stops", *_STOP[1:], "left(userId, 2) AS prefix", "state", *_D_YMD,
        tail="WHERE d BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
    ),
    "bin_hours": _query("hours", *_HOURS),
    "write_bin_hours": _bin_hours_table,
    "merge_flag": _query("flagged", "userId", "us:b AS begin", "us:e AS end", "m:jump AS distance_prev", "opens AS opens_group"),
    "merge_stops": _query("merged", *_MERGED),
    "merge_stops_by_state": _query("merged_v5", *_MERGED),
    "merge_stops_v3": _query("merged_v3", *_MERGED),
    "repair_overlaps": _query("repaired", *_MERGED),
    "cluster_places": _clustered,
    "cluster_places_large": _clustered,
    "cluster_centroids": _query(
        "centres", "userId", "clusterId", "deg:clat AS clusterLatitude", "deg:clon AS clusterLongitude"
    ),
    "geohash": _query(
        "pings", "userId", "us:t AS timestamp",
        *[f"{_geohash('latitude', 'longitude', n)} AS geohash{n}" for n in (5, 6, 7)],
    ),
    "local_offset": _query("located", "userId", "state", "clusterId", "us:b AS begin", "tzid", 'hours_ahead AS "offset"', "geohash7"),
    "visits": _query("located", *_VISIT),
    "write_visits": _query("located", *_VISIT),
    "visits_all_zones": _query("located_left", *_VISIT),
    "visits_v3": _query(
        "clustered_v3", "left(userId, 2) AS prefix", "userId", "clusterId", "us:b AS begin", "us:e AS end",
        "CAST(year(b) AS INT) AS year", "CAST(dayofyear(b) AS INT) AS dayofyear",
    ),
    "places": _query(
        "located", *_PLACE, "min(state) AS state", tail="GROUP BY prefix, userId, clusterId, clat, clon, geohash7"
    ),
    "places_distinct": _query("(SELECT DISTINCT prefix, userId, clusterId, clat, clon, geohash7, state FROM located_v5)",
                              *_PLACE, "state", tables=("located_v5",)),
    "places_by_year": _query(
        f"(SELECT DISTINCT left(c.userId, 2) AS prefix, c.userId, c.clusterId, g.clat, g.clon, "
        f"{_geohash('c.latitude', 'c.longitude', 6)} AS geohash6, CAST(year(c.b) AS INT) AS year "
        "FROM clustered_v3 c JOIN centres_v3 g USING (userId, clusterId))",
        "prefix", "userId", "clusterId", "deg:clat AS clusterLatitude", "deg:clon AS clusterLongitude", "geohash6",
        "year", tables=("clustered_v3", "centres_v3"),
    ),
}
ORACLES["write_places"] = ORACLES["places"]
ORACLES["rewrite_places"] = ORACLES["places"]
ORACLES["rewrite_stops"] = ORACLES["write_stops"]
ORACLES["user_table_merge"] = ORACLES["repair_overlaps"]
ORACLES["resumed_backfill"] = _query(
    """(
      SELECT 'stops' AS stage, u.day, CASE WHEN u.day = DATE '2024-01-08' THEN 2 ELSE 1 END AS runs, count(s.d) AS n_rows
      FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-05', DATE '2024-01-12', INTERVAL 1 DAY)) AS DATE) AS day) u
      LEFT JOIN stops s ON s.d = u.day GROUP BY u.day
      UNION ALL
      SELECT 'hours', u.day, 1, count(h.userId)
      FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-05', DATE '2024-01-12', INTERVAL 1 DAY)) AS DATE) AS day) u
      LEFT JOIN hours h ON h.year = 2024 AND h.dayofyear = dayofyear(u.day) GROUP BY u.day)""",
    "stage", "day:day", "CAST(runs AS BIGINT) AS runs", "CAST(n_rows AS BIGINT) AS n_rows", tables=("stops", "hours"),
)
ORACLES["pending_from_listing"] = ORACLES["pending_partitions"]
ORACLES["screened_scan"] = ORACLES["scan_tsv"]
ORACLES["merge_border_stops"] = _query("merged_border_state", *_MERGED)
ORACLES["repair_border_stops"] = _query("repaired_border", *_MERGED)
ORACLES["ingest_run"] = _query(
    "typed", "source AS table_name", "count(*) AS count_line_input",
    "count(*) FILTER (WHERE kept) AS count_line_output", "true AS timed", tail="GROUP BY source",
)
ORACLES["near_points"] = _query(
    f"""(
      SELECT p.ping, count(u.userId) FILTER (WHERE apart <= 1500) AS n_near,
        min({{'m': round(apart, 3), 'other': u.userId}}) FILTER (WHERE apart <= 1500) AS near
      FROM (SELECT event_id * 6 + k AS ping, radians(latitude) AS la, radians(longitude) AS lo FROM pings) p,
        (SELECT userId, radians(min(latitude)) AS la, radians(min(longitude)) AS lo FROM pings GROUP BY userId) u,
        LATERAL (SELECT {_hav('p.la', 'p.lo', 'u.la', 'u.lo')} AS apart)
      GROUP BY p.ping)""",
    "ping", "n_near", "near.other AS nearest", "near.m AS nearest_m", tables=("pings",),
)
ORACLES["detect_stops_sql"] = ORACLES["detect_stops"]
