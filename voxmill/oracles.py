"""DuckDB SQL for the queries of the volume engine, written apart from them."""

from __future__ import annotations

_BOXES = """boxes AS (SELECT p_partkey AS id, p_partkey * 37 % 997 + p_partkey // 2000 * 1000 AS ox, p_partkey * 91 % 991 AS oy, (p_partkey * 53 + p_partkey * p_partkey) % 983 AS oz,
  p_size::BIGINT * 4 + 20 AS sx, p_size::BIGINT * 3 + 40 AS sy, p_size::BIGINT * 2 + 60 AS sz FROM part)"""
_BBOX = """bbox AS (SELECT min(ox) AS ox, min(oy) AS oy, min(oz) AS oz, max(ox + sx) - min(ox) AS sx, max(oy + sy) - min(oy) AS sy, max(oz + sz) - min(oz) AS sz FROM boxes)"""
_NODES = """nodes AS (
  SELECT '' AS path, 0 AS level, 0::BIGINT AS morton, ox, oy, oz, sx, sy, sz FROM bbox
  UNION ALL
  SELECT CASE WHEN path = '' THEN d::VARCHAR ELSE path || '/' || d END, level + 1, morton * 8 + d - 1,
    ox + ((d - 1) & 1) * (sx >> 1), oy + (((d - 1) >> 1) & 1) * (sy >> 1), oz + (((d - 1) >> 2) & 1) * (sz >> 1),
    (sx >> 1) + ((d - 1) & 1) * (sx % 2), (sy >> 1) + (((d - 1) >> 1) & 1) * (sy % 2), (sz >> 1) + (((d - 1) >> 2) & 1) * (sz % 2)
  FROM nodes, (SELECT unnest(generate_series(1, 8)) AS d) WHERE level < 2)"""
_HIT = """a.ox < b.ox + b.sx AND b.ox < a.ox + a.sx AND a.oy < b.oy + b.sy AND b.oy < a.oy + a.sy AND a.oz < b.oz + b.sz AND b.oz < a.oz + a.sz"""
_VOXELS = """voxels AS (SELECT (l_orderkey >> 4) & 3 AS src, l_linenumber % 3 AS c, ((l_partkey & 15) + (l_orderkey >> 14) * 16)::INT AS x, (l_suppkey & 15)::INT AS y, (l_orderkey & 15)::INT AS z,
  (floor(l_extendedprice)::BIGINT & 65535)::INT AS v FROM lineitem)"""
_MERGED = """merged AS (SELECT c, x, y, z, max(v) AS v FROM voxels GROUP BY ALL)"""
_PATHS = """paths AS (SELECT o_orderkey AS k, o_orderkey % 512 + 1 AS job, o_orderstatus <> 'O' AS lit, (((o_orderkey >> 6) & 7) + 1) || '/' || (((o_orderkey >> 3) & 7) + 1) || '/' || ((o_orderkey & 7) + 1) AS path FROM orders)"""
_NODES3 = """xs AS (SELECT unnest([1, 2, 3]) AS ix), ys AS (SELECT unnest([1, 2]) AS iy), zs AS (SELECT unnest([1, 2, 3]) AS iz),
grid AS (SELECT id, ix, iy, iz, ox + sx * (ix - 1) // 2 AS x, oy + sy * (iy - 1) AS y, oz + sz * (iz - 1) // 2 AS z FROM boxes, xs, ys, zs),
cells AS (SELECT DISTINCT id, ix, iy, iz FROM grid WHERE ix < 3 AND iy < 2 AND iz < 3),
corners AS (SELECT c.id, c.ix, c.iy, c.iz, b, g.x, g.y, g.z FROM cells c, (SELECT unnest(generate_series(0, 7)) AS b) bs
  JOIN grid g ON g.id = c.id AND g.ix = c.ix + (b & 1) AND g.iy = c.iy + ((b >> 1) & 1) AND g.iz = c.iz + ((b >> 2) & 1))"""
_SUB = """subtiles AS (SELECT id, ix, iy, iz, min(x) AS ox, min(y) AS oy, min(z) AS oz, max(x) - min(x) AS sx, max(y) - min(y) AS sy, max(z) - min(z) AS sz FROM corners GROUP BY id, ix, iy, iz)"""

_LEAF = ["reading input tile", "initializing", "transforming", "saving output tiles", "waiting"]
_MERGE = ["copying / moving single", "merging multiple", "clearing multiple", "reading multiple", "max''ing multiple", "deleting multiple", "writing multiple"]
_TREE = ["clearing octree", "downsampling octree", "saving octree"]
_quoted = lambda xs: ", ".join(f"'{x}'" for x in xs)
_LINES = f"""texts AS (SELECT *, ([{_quoted([*_LEAF, *_MERGE, *_TREE, "overall"])}])[event_id % 16 + 1] AS text FROM events),
lines AS (SELECT 'squatter' || (user_id % 20) || '.log' AS file, event_id, CASE
  WHEN event_type = 'error' THEN '[ ERROR: ' || text || ' might have failed'
  WHEN event_type = 'signup' AND event_id % 3 = 0 THEN '[ WARNING: ' || text
  WHEN event_type = 'view' AND event_id % 5 = 0 THEN 'Segmentation fault in ' || text
  ELSE '[ Info: PEON: ' || text || ' took ' || coalesce(value, 0)::DECIMAL(18, 2) || ' sec' END AS line FROM texts),
timed AS (SELECT *, ('0' || regexp_extract(line, '([0-9.]*) sec', 1))::DOUBLE AS sec FROM lines WHERE contains(line, 'took')),
cats AS (SELECT unnest([{_quoted([*_LEAF, "overall", "peons", "squatters", "merging", *_MERGE, *_TREE])}]) AS category),
tagged AS (SELECT * FROM timed JOIN cats ON contains(line, category))"""
_MONITOR = """kb AS (SELECT *, floor(coalesce(value, 0) * 1000)::BIGINT AS kb FROM events),
samples AS (SELECT event_id, 'node' || user_id AS node, CASE WHEN event_id % 7 = 0 THEN NULL ELSE kb * 1e6 END::DOUBLE AS mem_used, 0::DOUBLE AS swap_used, 1e10::DOUBLE AS scratch,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE 5e6 END::DOUBLE AS rx, 3e6::DOUBLE AS tx, (kb % 100)::DOUBLE AS load, (event_id % 50)::DOUBLE AS ntiles FROM kb WHERE event_id % 13 <> 0)"""


def _with(*parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n"


def _octants(src: str) -> str:
    o = ", ".join(f"o{a} + (((digit - 1) >> {k}) & 1) * (s{a} >> 1) AS o{a}" for k, a in enumerate("xyz"))
    s = ", ".join(f"(s{a} >> 1) + (((digit - 1) >> {k}) & 1) * (s{a} % 2) AS s{a}" for k, a in enumerate("xyz"))
    return f"SELECT id, digit, {o}, {s} FROM {src}, (SELECT unnest(generate_series(1, 8))::INT AS digit)"


def _face(k: str, digits: str) -> str:
    return " || ".join(f"substr('{digits}', ({k} % 64 // {d} % 4)::INT + 1, 1)" for d in (16, 4, 1))


def _quad_bits(name: str, axis: int) -> str:
    return " + ".join(f"(((substr({name}, {i + 1}, 1)::INT - 1) >> {axis}) & 1) * {4 >> i}" for i in range(3))


def _ranked(extra: str = "") -> str:
    return f"ranked AS (SELECT c, x >> 1 AS x, y >> 1 AS y, z >> 1 AS z, v, row_number() OVER (PARTITION BY c, x >> 1, y >> 1, z >> 1 ORDER BY v DESC{extra}) AS k FROM merged)"


def _second(src: str, out: str) -> str:
    return f"""{out} AS (SELECT c, x, y, z, coalesce(max(CASE WHEN k = 2 THEN v END), 0) AS v FROM
  (SELECT c, x >> 1 AS x, y >> 1 AS y, z >> 1 AS z, v, row_number() OVER (PARTITION BY c, x >> 1, y >> 1, z >> 1 ORDER BY v DESC) AS k FROM {src}) GROUP BY c, x, y, z)"""


_UNION = "min(ox) AS ox, min(oy) AS oy, min(oz) AS oz, max(ox + sx) - min(ox) AS sx, max(oy + sy) - min(oy) AS sy, max(oz + sz) - min(oz) AS sz"
_STACK = f"""faces AS (SELECT {_face("i", "1234")} AS face FROM (SELECT unnest(generate_series(0, 63)) AS i)),
stack AS (SELECT face, d::INT AS i, {" || ".join(f"(substr(face, {j + 1}, 1)::INT + ((d >> {2 - j}) & 1) * 4)" for j in range(3))} AS leaf FROM faces, (SELECT unnest(generate_series(0, 7)) AS d)),
leaves AS (SELECT replace(path, '/', '') AS leaf FROM paths GROUP BY 1 HAVING arg_max(lit, k)),
found AS (SELECT face, i, leaf, min(i) OVER (PARTITION BY face) AS skipped, (row_number() OVER (PARTITION BY face ORDER BY i) - 1)::INT AS position FROM stack SEMI JOIN leaves USING (leaf))"""

ORACLES = {
    "tile_catalog": _with(_BOXES) + "SELECT id, printf('/%02d/%05d', id % 100, id) AS path, ox, oy, oz, sx, sy, sz, '16,32,64,1' AS dims, '3,' || (id % 20 + 10) || ',60' AS zlims FROM boxes",
    "load_tiles": _with(_VOXELS) + "SELECT 'tile-' || src || '-' || (x >> 4) AS path, c, x % 16 AS x, y, z, max(v) AS v FROM voxels WHERE v > 0 GROUP BY ALL",
    "tile_count": _with(_BOXES) + "SELECT printf('/%02d', id % 100) AS folder, count(*) AS n, min(id) AS first_id FROM boxes GROUP BY 1",
    "tile_attrs": _with(_BOXES) + "SELECT id, printf('/%02d/%05d', id % 100, id) AS path, 1 AS nchannels, ox || ',' || oy || ',' || oz AS ori FROM boxes",
    "grid_validate": _with(_BOXES) + """SELECT id, concat_ws(',', CASE WHEN id % 7 = 0 THEN 'xlims_even' END, CASE WHEN id % 11 = 0 THEN 'zlims_rising' END, CASE WHEN id % 10 = 0 THEN 'zlims_inside' END) AS broken FROM boxes""",
    "grid_validate_shared": _with(_BOXES) + """SELECT 'same_zlims_count' AS rule, count(DISTINCT id % 13 = 0 AND id % 11 <> 0) AS kinds, count(DISTINCT id % 13 = 0 AND id % 11 <> 0) > 1 AS broken FROM boxes
UNION ALL SELECT 'same_xlims', count(DISTINCT id % 7 = 0), count(DISTINCT id % 7 = 0) > 1 FROM boxes UNION ALL SELECT 'same_ylims', 1, false""",
    "aabb_hit": _with(_BOXES) + f"SELECT a.id, count(*) AS hits FROM boxes a JOIN boxes b ON {_HIT} GROUP BY a.id",
    "aabb_set": _with(_BOXES) + "SELECT id, CASE WHEN id % 2 = 0 THEN ox + 5 ELSE ox END AS ox, oy, oz, sx, sy, 7::BIGINT AS sz FROM boxes",
    "aabb_volume": _with(_BOXES) + "SELECT id, sx::DOUBLE * sy * sz AS volume FROM boxes",
    "aabb_union_pair": _with(_BOXES) + "SELECT a.id, " + ", ".join(f"least(a.o{x}, b.o{x}) AS o{x}, greatest(a.o{x} + a.s{x}, b.o{x} + b.s{x}) - least(a.o{x}, b.o{x}) AS s{x}" for x in "xyz") + " FROM boxes a JOIN boxes b ON b.id = a.id + 1",
    "aabb_union": _with(_BOXES) + f"SELECT id % 25 AS part, {_UNION} FROM boxes GROUP BY 1",
    "octree_subdivide": _with(_BOXES) + _octants("boxes"),
    "kd_halve": _with(_BOXES, "b AS (SELECT *, CASE WHEN sx >= sy AND sx >= sz THEN 0 WHEN sy >= sz THEN 1 ELSE 2 END AS ax FROM boxes), u AS (SELECT unnest([false, true]) AS upper)")
    + "SELECT id, upper, " + ", ".join(f"CASE WHEN ax = {k} AND upper THEN o{x} + s{x} // 2 ELSE o{x} END AS o{x}, CASE WHEN ax <> {k} THEN s{x} WHEN upper THEN s{x} - s{x} // 2 ELSE s{x} // 2 END AS s{x}" for k, x in enumerate("xyz")) + " FROM b, u",
    "is_leaf": _with(_BOXES) + "SELECT id, (sx * sy * sz) / 8.0 < 50000 AS leaf FROM boxes",
    "plan_nlevels": _with(_BOXES) + "SELECT id, greatest(0, ceil(round(log2(sx * sy * sz * 1000.0 / 8.0 / 20000) / 3, 9)))::INT AS nlevels FROM boxes",
    "leaf_shape_search": _with(_BOXES, f"u AS (SELECT id % 5 AS g, {_UNION} FROM boxes GROUP BY 1), d AS (SELECT unnest(generate_series(-20, 20, 2))::BIGINT AS d)",
        "t AS (SELECT g, sx - sx % 2 + x.d AS px, sy - sy % 2 + y.d AS py, sz - sz % 2 + z.d AS pz, x.d AS dx, y.d AS dy, z.d AS dz, abs(x.d) + abs(y.d) + abs(z.d) AS cost FROM u, d x, d y, d z)")
    + "SELECT g, px, py, pz, dx, dy, dz, cost FROM t WHERE px * py * pz % 4096 = 0 AND px > 0 AND py > 0 AND pz > 0 QUALIFY row_number() OVER (PARTITION BY g ORDER BY cost, dx, dy, dz) = 1",
    "transform_params": _with(_BOXES, f"u AS (SELECT id % 5 AS g, {_UNION} FROM boxes GROUP BY 1)") + "SELECT g, ox, oy, oz, sx / 1000.0 / 4 / 64 AS voxel_um_x, sy / 1000.0 / 4 / 64 AS voxel_um_y, sz / 1000.0 / 4 / 64 AS voxel_um_z, 3 AS nl FROM u",
    "roi_box": _with(_BOXES) + "SELECT id, " + ", ".join(f"round_even(o{x} + s{x} * {f}, 0)::BIGINT AS o{x}, round_even(s{x} * {h}, 0)::BIGINT AS s{x}" for x, f, h in (("x", "0.0::DOUBLE", "1.0::DOUBLE"), ("y", "0.25::DOUBLE", "0.5::DOUBLE"), ("z", "0.5::DOUBLE", "0.5::DOUBLE"))) + " FROM boxes",
    "roi_from_morton": _with(_PATHS, "f AS (SELECT k, ((k >> 6) & 7) AS a, ((k >> 3) & 7) AS b, (k & 7) AS c FROM paths)") + "SELECT k, " + ", ".join(f"((a >> {i}) & 1) / 2.0::DOUBLE + ((b >> {i}) & 1) / 4.0::DOUBLE + ((c >> {i}) & 1) / 8.0::DOUBLE AS f{x}" for i, x in enumerate("xyz")) + ", 0.125::DOUBLE AS size FROM f",
    "tiles_in_roi": _with(_BOXES, _BBOX, "roi AS (SELECT round_even(ox::DOUBLE, 0)::BIGINT AS ox, round_even(oy::DOUBLE, 0)::BIGINT AS oy, round_even(oz + sz * 0.5::DOUBLE, 0)::BIGINT AS oz, round_even(sx * 0.5::DOUBLE, 0)::BIGINT AS sx, round_even(sy * 0.5::DOUBLE, 0)::BIGINT AS sy, round_even(sz * 0.5::DOUBLE, 0)::BIGINT AS sz FROM bbox)")
    + f"SELECT a.* FROM boxes a, roi b WHERE {_HIT} AND a.ox >= b.ox AND a.oy >= b.oy AND a.oz >= b.oz",
    "roi_scan": _with(_BOXES, _BBOX, "roi AS (SELECT round_even(ox + sx * 0.25::DOUBLE, 0)::BIGINT AS ox, round_even(oy + sy * 0.125::DOUBLE, 0)::BIGINT AS oy, round_even(oz + sz * 0.25::DOUBLE, 0)::BIGINT AS oz, round_even(sx * 0.25::DOUBLE, 0)::BIGINT AS sx, round_even(sy * 0.5::DOUBLE, 0)::BIGINT AS sy, round_even(sz * 0.5::DOUBLE, 0)::BIGINT AS sz FROM bbox)")
    + "SELECT a.* FROM boxes a, roi b WHERE a.ox >= b.ox AND a.oy >= b.oy AND a.oz >= b.oz AND a.ox < b.ox + b.sx AND a.oy < b.oy + b.sy AND a.oz < b.oz + b.sz",
    "subtile_corners": _with(_BOXES, _NODES3) + "SELECT id, ix, iy, iz, CASE WHEN (ix + iy + iz) % 2 = 1 THEN 90 ELSE 0 END AS orientation, " + ", ".join(f"(1 + ix - 1 + {b & 1} + 3 * (iy - 1 + {b >> 1 & 1}) + 6 * (iz - 1 + {b >> 2 & 1}))::INT AS corner{b}" for b in range(8)) + " FROM cells",
    "subtile_aabb": _with(_BOXES, _NODES3, _SUB) + "SELECT * FROM subtiles",
    "leaf_transform": _with(_BOXES, _BBOX, _NODES3) + "SELECT c.id, c.ix, c.iy, c.iz, b::INT AS b, " + ", ".join(f"round((c.{x} - r.o{x}) / (r.s{x} / 64.0::DOUBLE), 6) AS p{x}" for x in "xyz") + " FROM corners c, bbox r",
    "subtile_slice": _with(_VOXELS) + "SELECT src, cell, count(*) AS n, sum(v)::BIGINT AS total FROM voxels, (VALUES (0, 0, 7), (1, 7, 15)) s(cell, low, high) WHERE z BETWEEN low AND high GROUP BY ALL",
    "morton_decode": _with(_PATHS) + "SELECT k, " + ", ".join("(" + " + ".join(f"(((k % 4096) >> {3 * b + i}) & 1) * {1 << b}" for b in range(4)) + f")::BIGINT AS {x}" for i, x in enumerate("xyz")) + ", k % 4096 AS again FROM paths",
    "face_paths": _with(_PATHS) + f"SELECT k, {_face('k', '1357')} AS face1, {_face('k', '1256')} AS face2, {_face('k', '1234')} AS face3 FROM paths",
    "quadtree_to_xy": _with(_PATHS, f"q AS (SELECT k, {_face('k', '1234')} AS quad FROM paths)") + f"SELECT k, quad, ({_quad_bits('quad', 0)})::INT AS u, ({_quad_bits('quad', 1)})::INT AS v FROM q",
    "face_leaf_stack": _with(_PATHS, _STACK) + "SELECT face, i, leaf, skipped, position FROM found",
    "face_stack_voxels": _with(_PATHS, _STACK) + "SELECT face, position * 4 + k % 4 AS depth, max(k % 65536) AS v FROM paths p JOIN found f ON f.leaf = replace(p.path, '/', '') GROUP BY ALL",
    "crop_range": _with(_BOXES) + """SELECT id, CASE WHEN id % 5 = 0 THEN 1 ELSE greatest(1, round_even((oz + sx / 4.0 - oz) / 0.5, 0)::BIGINT - id % 2 * 16) END AS crop_from,
  CASE WHEN id % 7 = 0 THEN 128 ELSE least(128, round_even((oz + sx / 2.0 - oz) / 0.5, 0)::BIGINT - id % 2 * 16) END AS crop_to FROM boxes""",
    "scale_clamp": _with(_VOXELS) + f"SELECT src, sum(round_even(greatest(0.0, least(1.0, (v - 1000.0::DOUBLE) / 49000.0::DOUBLE)) * 65535.0::DOUBLE, 0))::BIGINT AS total FROM voxels GROUP BY src",
    "path_ops": _with(_PATHS) + "SELECT k, k || '-' || job || '-' || path AS prefix, ((k & 7) + 1)::INT AS last, " + ", ".join(f"(((k & 7) >> {i}) & 1)::INT * 24 AS at_{x}" for i, x in enumerate("xyz")) + " FROM paths",
    "octal_digits": _with(_PATHS) + "SELECT k, ((((job - 1) >> 6) & 7) + 1)::INT AS d0, ((((job - 1) >> 3) & 7) + 1)::INT AS d1, (((job - 1) & 7) + 1)::INT AS d2 FROM paths",
    "human_readable": """WITH s AS (SELECT o_orderkey, (o_orderkey * o_orderkey * 37)::VARCHAR AS s FROM orders)
SELECT o_orderkey, CASE WHEN length(s) > 9 THEN s[:-10] || 'T' WHEN length(s) > 6 THEN s[:-7] || 'G' WHEN length(s) > 3 THEN s[:-4] || 'M' ELSE s || 'B' END AS size FROM s""",
    "string_scalars": _with(_LINES) + """SELECT event_id, replace(line, 'took', 'used') AS replaced, starts_with(line, '[ Info') AS is_info, ends_with(line, 'sec') AS is_timed, len(string_split(line, ' '))::INT AS words,
  regexp_extract(line, '([A-Z]+): ', 1) AS role, regexp_matches(line, 'octree|merging') AS is_tree FROM lines""",
    "math_scalars": _with(_BOXES) + """SELECT id, ceil(sx / 7.0)::BIGINT AS up, sx // 7 AS down, round_even(sx / 8.0, 0)::BIGINT AS even, round(log2(sy::DOUBLE), 9) AS lg, abs(ox - oy) AS gap, greatest(ox, oy, oz) AS most, least(ox, oy, oz) AS least,
  ((ox - 500) % 7 + 7) % 7 AS left, ox >> 2 AS quarter, sz << 1 AS twice, ox & oy AS both, CASE WHEN sx >= sy AND sx >= sz THEN 0 WHEN sy >= sz THEN 1 ELSE 2 END AS longest FROM boxes""",
    "array_scalars": """WITH l AS (SELECT vec_id, label, embedding, [vec_id % 11, vec_id * 3 % 11, vec_id * 5 % 11, vec_id * 7 % 11] AS lims FROM embeddings)
SELECT vec_id, array_to_string(list_sort(list_distinct(lims)), ',') AS ordered, array_to_string(list_reverse(lims), ',') AS backwards,
  coalesce(array_to_string(list_transform(list_sort(list_transform(list_distinct(list_filter(lims, lambda x: x <> label)), lambda x: list_position(lims, x))), lambda i: lims[i]), ','), '') AS without,
  len(list_filter(embedding, lambda x: x > 0))::INT AS positive, label || ',' || label AS repeated, list_position(lims, lims[4])::BIGINT AS found FROM l""",
    "leaf_tile_overlap": _with(_BOXES, _BBOX, _NODES, recursive=True) + f"SELECT b.path, a.id FROM boxes a JOIN nodes b ON b.level = 2 AND {_HIT}",
    "leaf_tile_count": _with(_BOXES, _BBOX, _NODES, recursive=True) + f"SELECT b.morton, count(DISTINCT a.id) AS ntiles FROM boxes a JOIN nodes b ON b.level = 2 AND {_HIT} GROUP BY 1",
    "solo_leaves": _with(_BOXES, _BBOX, _NODES.replace("level < 2", "level < 5"), recursive=True) + f"SELECT b.path, min(a.id) AS id FROM boxes a JOIN nodes b ON b.level = 5 AND {_HIT} GROUP BY b.path HAVING count(*) = 1",
    "octree_descend": _with(_BOXES, _BBOX, _NODES, recursive=True) + f"SELECT b.path, b.level, count(*) AS ntiles FROM boxes a JOIN nodes b ON {_HIT} GROUP BY ALL",
    "subtiles_per_leaf": _with(_BOXES, _BBOX, _NODES, _NODES3, _SUB, recursive=True) + f"SELECT b.path, a.id, count(*) AS expected FROM subtiles a JOIN nodes b ON b.level = 2 AND {_HIT} GROUP BY ALL",
    "tiles_per_box": _with(_BOXES, _BBOX, _NODES, recursive=True) + f"SELECT b.path, count(*) AS ntiles FROM boxes a JOIN nodes b ON b.level = 1 AND {_HIT} GROUP BY ALL",
    "kd_jobs": _with(_BOXES, _BBOX, """jobs AS (
  SELECT r.*, (SELECT count(*) FROM boxes) AS n FROM bbox r
  UNION ALL
  SELECT h.*, (SELECT count(*) FROM boxes t WHERE t.ox >= h.ox AND t.ox < h.ox + h.sx AND t.oy >= h.oy AND t.oy < h.oy + h.sy AND t.oz >= h.oz AND t.oz < h.oz + h.sz) FROM (
    SELECT CASE WHEN ax = 0 AND u THEN ox + sx // 2 ELSE ox END AS ox, CASE WHEN ax = 1 AND u THEN oy + sy // 2 ELSE oy END AS oy, CASE WHEN ax = 2 AND u THEN oz + sz // 2 ELSE oz END AS oz,
      CASE WHEN ax <> 0 THEN sx WHEN u THEN sx - sx // 2 ELSE sx // 2 END AS sx, CASE WHEN ax <> 1 THEN sy WHEN u THEN sy - sy // 2 ELSE sy // 2 END AS sy, CASE WHEN ax <> 2 THEN sz WHEN u THEN sz - sz // 2 ELSE sz // 2 END AS sz
    FROM (SELECT *, CASE WHEN sx >= sy AND sx >= sz THEN 0 WHEN sy >= sz THEN 1 ELSE 2 END AS ax FROM jobs WHERE n > 120 AND greatest(sx, sy, sz) > 1), (SELECT unnest([false, true]) AS u)) h)""", recursive=True)
    + "SELECT row_number() OVER (ORDER BY n DESC, ox, oy, oz, sx, sy, sz) AS job, ox, oy, oz, sx, sy, sz, n AS ntiles FROM jobs WHERE n > 0 AND (n <= 120 OR greatest(sx, sy, sz) <= 1)",
    "tile_locality_order": _with(_BOXES, _BBOX, _NODES, f"f AS (SELECT a.id, min(b.morton) AS first_leaf FROM boxes a JOIN nodes b ON b.level = 2 AND {_HIT} GROUP BY 1)", recursive=True) + "SELECT id, first_leaf, row_number() OVER (ORDER BY first_leaf, id) AS rank FROM f",
    "max_merge": _with(_VOXELS, _MERGED) + "SELECT * FROM merged",
    "max_merge_bricks": _with(_VOXELS, _MERGED) + "SELECT * FROM merged WHERE v > 0",
    "merge_octrees": _with(_VOXELS) + "SELECT c, x, y, z, max(v) AS v FROM voxels GROUP BY ALL",
    "exclude_nodes": _with(_VOXELS) + "SELECT x, y, count(*) AS n FROM voxels ANTI JOIN (SELECT x, y, z FROM voxels WHERE v > 65000) USING (x, y, z) GROUP BY ALL",
    "downsample_first": _with(_VOXELS, _MERGED) + "SELECT c, x >> 1 AS x, y >> 1 AS y, z >> 1 AS z, v FROM merged WHERE x % 2 = 0 AND y % 2 = 0 AND z % 2 = 0",
    "downsample_mean": _with(_VOXELS, _MERGED) + "SELECT c, x >> 1 AS x, y >> 1 AS y, z >> 1 AS z, (sum(v)::BIGINT >> 3)::INT AS v FROM merged GROUP BY 1, 2, 3, 4",
    "downsample_second": _with(_VOXELS, _MERGED, _ranked()) + "SELECT c, x, y, z, coalesce(max(CASE WHEN k = 2 THEN v END), 0) AS v FROM ranked GROUP BY ALL",
    "downsample_nth_nonzero": _with(_VOXELS, _MERGED, _ranked()) + "SELECT c, x, y, z, coalesce(min(CASE WHEN k <= 5 AND v > 0 THEN v END), 0) AS v FROM ranked GROUP BY ALL",
    "octree_pyramid": _with(_VOXELS, _MERGED, _second("merged", "two"), _second("two", "one"), _second("one", "zero")) + "SELECT 3 AS level, * FROM merged UNION ALL SELECT 2, * FROM two UNION ALL SELECT 1, * FROM one UNION ALL SELECT 0, * FROM zero",
    "custom_udaf": _with(_VOXELS, _MERGED) + "SELECT c, x >> 1 AS x, y >> 1 AS y, z >> 1 AS z, max(v) - min(v) AS v FROM merged GROUP BY 1, 2, 3, 4",
    "channel_subtract": _with(_VOXELS, _MERGED, """two AS (SELECT x, y, z, coalesce(max(CASE WHEN c = 0 THEN v END), 0)::DOUBLE AS s, coalesce(max(CASE WHEN c = 1 THEN v END), 0)::DOUBLE AS r FROM merged WHERE c < 2 GROUP BY ALL)""")
    + "SELECT x, y, z, round_even(greatest(0, least(65535, greatest(0.0, least(1.0, (s - 1000.0::DOUBLE) / 49000.0::DOUBLE)) * 65535.0::DOUBLE - greatest(0.0, least(1.0, (r - 2000.0::DOUBLE) / 58000.0::DOUBLE)) * 65535.0::DOUBLE)), 0)::INT AS p FROM two",
    "projection_image": _with(_VOXELS, _MERGED, """two AS (SELECT x, y, z, coalesce(max(CASE WHEN c = 0 THEN v END), 0) - coalesce(max(CASE WHEN c = 1 THEN v END), 0) AS d FROM merged WHERE c < 2 GROUP BY ALL)""")
    + "SELECT y AS x, z AS y, max(d)::INT AS p FROM two WHERE x + 1 BETWEEN 3 AND 40 GROUP BY ALL HAVING max(d) > 0",
    "project_max": _with(_VOXELS, _MERGED) + "SELECT x, y, max(v)::DOUBLE AS p FROM merged WHERE c = 0 AND z BETWEEN 2 AND 13 GROUP BY ALL",
    "project_p999": _with(_VOXELS, _MERGED) + "SELECT x, y, round(quantile_cont(v::DOUBLE, 0.999), 4) AS p FROM merged WHERE c = 0 AND z BETWEEN 2 AND 13 GROUP BY ALL",
    "project_median_max": _with(_VOXELS, _MERGED, """xy AS (SELECT DISTINCT x, y FROM merged WHERE c = 0), zs AS (SELECT unnest(generate_series(0, 15))::INT AS z), ks AS (SELECT unnest(generate_series(-2, 2)) AS k),
seen AS (SELECT xy.x, xy.y, zs.z, median(coalesce(m.v, 0)::DOUBLE) AS d FROM xy, zs, ks LEFT JOIN merged m ON m.c = 0 AND m.x = xy.x AND m.y = xy.y AND m.z = greatest(0, least(15, zs.z + ks.k)) GROUP BY ALL)""")
    + "SELECT x, y, max(d) AS p FROM seen WHERE z BETWEEN 2 AND 13 GROUP BY ALL",
    "project_second": _with(_VOXELS, _MERGED, "r AS (SELECT x, y, v, row_number() OVER (PARTITION BY x, y ORDER BY v DESC) AS k FROM merged WHERE c = 0 AND z BETWEEN 2 AND 13)") + "SELECT x, y, coalesce(max(CASE WHEN k = 2 THEN v END), 0)::DOUBLE AS p FROM r GROUP BY ALL",
    "mosaic": _with(_PATHS, f"q AS (SELECT k, {_face('k', '1234')} AS quad FROM paths)") + f"SELECT ({_quad_bits('quad', 0)}) * 4 + (k >> 6) % 4 AS u, ({_quad_bits('quad', 1)}) * 4 + (k >> 8) % 4 AS v, max(k * 7919 % 65536) AS p FROM q GROUP BY 1, 2",
    "octree_listing": _with(_PATHS) + "SELECT DISTINCT path || '/default' AS base, (k % 3)::INT AS c FROM paths",
    "leaf_only_scan": _with(_PATHS) + "SELECT path, 3 AS level, count(*) AS files FROM paths GROUP BY path",
    "face_listing": _with(_PATHS) + f"SELECT DISTINCT {_face('k', '1234')} AS face FROM paths WHERE k % 4 <> 0 AND k % 5 <> 0",
    "log_scan": _with(_LINES) + "SELECT event_id, file, sec FROM timed",
    "stage_profile": _with(_LINES) + """SELECT category, count(*) AS n, min(sec) AS least, max(sec) AS most, sum(sec::DECIMAL(20, 2))::DOUBLE AS total,
  round(quantile_cont(sec, 0.25), 6) AS q25, round(quantile_cont(sec, 0.5), 6) AS q50, round(quantile_cont(sec, 0.75), 6) AS q75 FROM tagged GROUP BY category""",
    "profile_bar": _with(_LINES) + f"""SELECT CASE WHEN category IN ({_quoted(_LEAF)}) THEN 'leaf' WHEN category IN ({_quoted(_MERGE)}) THEN 'merge' ELSE 'octree' END AS stage_group, category,
  round(sum(sec::DECIMAL(20, 2))::DOUBLE / 3600, 9) AS hours FROM tagged WHERE category IN ({_quoted([*_LEAF, *_MERGE, *_TREE])}) GROUP BY ALL""",
    "log_counts": _with(_LINES) + """SELECT file, count(*) FILTER (contains(line, 'reading input tile')) AS tiles_read, count(*) FILTER (regexp_matches(line, '(copying (from|to))|(saving output)')) AS outputs_saved,
  count(*) FILTER (contains(line, 'ERROR')) AS errors, count(*) FILTER (contains(line, 'might have failed')) AS failures, count(*) FILTER (contains(line, 'WARNING')) AS warnings, count(*) FILTER (contains(line, 'Segmentation fault')) AS faults FROM lines GROUP BY file
HAVING tiles_read + outputs_saved + errors + failures + warnings + faults > 0""",
    "timing_rollup": _with(_LINES) + "SELECT file, category, sum(sec::DECIMAL(20, 2))::DOUBLE AS total FROM tagged GROUP BY ALL",
    "monitor_scan": _with(_MONITOR) + "SELECT * FROM samples",
    "cluster_series_sum": _with(_MONITOR) + "SELECT seq::INT AS seq, sum(ntiles)::BIGINT AS ntiles FROM (SELECT row_number() OVER (PARTITION BY node ORDER BY event_id) AS seq, ntiles FROM samples) GROUP BY seq",
    "node_rates": """WITH t AS (SELECT user_id AS node, event_id AS seq, (event_id * 104857600 + floor(coalesce(value, 0) * 1000000)::BIGINT) * 3 AS rx FROM events)
SELECT node, seq, rx, (rx - lag(rx) OVER (PARTITION BY node ORDER BY seq)) // 600 // 1024 // 1024 AS mbps FROM t""",
    "stack_range": _with(_VOXELS) + "SELECT 't/' || (x >> 4) AS path, c, (x % 16)::INT AS x, y, z, max(v) AS v FROM voxels WHERE c = 1 AND z BETWEEN 3 AND 8 AND v > 0 GROUP BY ALL",
    "incomplete_outputs": _with(_VOXELS) + "SELECT x, y, z, count(DISTINCT src) AS ready, max(v % 5)::BIGINT AS expected FROM voxels GROUP BY ALL HAVING expected > 1 AND expected <> ready",
    "resample_nearest": _with(_BOXES, _BBOX, _NODES, _NODES3, _SUB, "g AS (SELECT unnest(generate_series(0, 7))::INT AS i)",
        "bricks AS (SELECT l_partkey AS id, (l_suppkey & 3) AS kx, (l_orderkey & 3) AS ky, (l_linenumber & 3) AS kz, max((floor(l_extendedprice)::BIGINT & 65535)::INT) AS v FROM lineitem GROUP BY ALL)",
        *[f"""on{x} AS (SELECT DISTINCT * EXCLUDE (pos), unnest([greatest(0, ceil(pos - 1e-9::DOUBLE) - 1)::INT, least(3, floor(pos + 1e-9::DOUBLE))::INT]) AS k{x} FROM (
  SELECT b.path, a.id, a.ix, a.iy, a.iz, g.i AS {x}, (b.o{x} + g.i * b.s{x} / 8.0::DOUBLE - a.o{x}) / a.s{x} * 4 AS pos
  FROM subtiles a JOIN nodes b ON b.level = 2 AND {_HIT} CROSS JOIN g) WHERE pos / 4 BETWEEN -1e-7::DOUBLE AND 1 + 1e-7::DOUBLE)""" for x in "xyz"], recursive=True)
    + "SELECT path, x, y, z, max(v) AS v FROM onx JOIN ony USING (path, id, ix, iy, iz) JOIN onz USING (path, id, ix, iy, iz) JOIN bricks USING (id, kx, ky, kz) WHERE v > 0 GROUP BY ALL",
    "resample_linear": _with(_BOXES, _BBOX, _NODES, _NODES3, _SUB, "g AS (SELECT unnest(generate_series(0, 7))::INT AS i)",
        "bricks AS (SELECT l_partkey AS id, (l_suppkey & 3) AS kx, (l_orderkey & 3) AS ky, (l_linenumber & 3) AS kz, max((floor(l_extendedprice)::BIGINT & 65535)::INT) AS v FROM lineitem GROUP BY ALL)",
        *[f"""at{x} AS (SELECT DISTINCT b.path, a.id, a.ix, a.iy, a.iz, g.i AS {x}, least(3, greatest(0, (b.o{x} + g.i * b.s{x} / 8.0::DOUBLE - a.o{x}) / a.s{x} * 4 - 0.5::DOUBLE)) AS pos
  FROM subtiles a JOIN nodes b ON b.level = 2 AND {_HIT} CROSS JOIN g WHERE (b.o{x} + g.i * b.s{x} / 8.0::DOUBLE - a.o{x}) / a.s{x} BETWEEN -1e-7::DOUBLE AND 1 + 1e-7::DOUBLE),
on{x} AS (SELECT * EXCLUDE (pos), least(2, floor(pos))::INT AS k{x}, 1 - (pos - least(2, floor(pos))) AS w{x} FROM at{x} UNION ALL SELECT * EXCLUDE (pos), least(2, floor(pos))::INT + 1, pos - least(2, floor(pos)) FROM at{x})""" for x in "xyz"], recursive=True)
    + """SELECT path, x, y, z, max(v) AS v FROM (SELECT path, id, ix, iy, iz, x, y, z, floor(sum(wx * wy * wz * v) + 0.5 + 1e-6::DOUBLE)::INT AS v
  FROM onx JOIN ony USING (path, id, ix, iy, iz) JOIN onz USING (path, id, ix, iy, iz) JOIN bricks USING (id, kx, ky, kz) GROUP BY ALL) WHERE v > 0 GROUP BY ALL""",
    "gaussian_downsample": _with(_VOXELS, _MERGED, "image AS (SELECT x, y, max(v)::DOUBLE AS p FROM merged WHERE c = 0 AND z BETWEEN 2 AND 13 GROUP BY ALL)",
        "size AS (SELECT 16 * (coalesce(max(x >> 4), 0) + 1) AS n FROM image)",
        *[f"""at{x} AS (SELECT t, n, least(greatest((t + 0.5::DOUBLE) * {r} - 0.5, 0), n - 1) AS pos FROM (SELECT {n} AS n, unnest(generate_series(0, ({m} - 1)::BIGINT)) AS t FROM size)),
end{x} AS (SELECT t, n, floor(pos)::INT AS i, 1 - (pos - floor(pos)) AS w FROM at{x} UNION ALL SELECT t, n, least(floor(pos) + 1, n - 1)::INT, pos - floor(pos) FROM at{x} WHERE pos > floor(pos)),
tap{x} AS (SELECT t, i, w, a, exp(-((a - i) / {s}) * ((a - i) / {s}) / 2) AS g FROM (SELECT t, i, w, unnest(generate_series(greatest(0, i - {k}), least(n - 1, i + {k}))) AS a FROM end{x})),
w{x} AS (SELECT t, a, sum(w * g / total) AS w FROM (SELECT *, sum(g) OVER (PARTITION BY t, i) AS total FROM tap{x}) GROUP BY ALL)""" for x, n, m, r, s, k in (("x", "n", "n * 6 // 16", "(16 / 6::DOUBLE)", "(0.75::DOUBLE * 16 / 6)", 8), ("y", "16", "5", "(16 / 5::DOUBLE)", "(0.75::DOUBLE * 16 / 5)", 10))],
        "across AS (SELECT wx.t AS x, image.y, sum(p * w) AS p FROM image JOIN wx ON wx.a = image.x GROUP BY ALL)")
    + "SELECT x::INT AS x, wy.t::INT AS y, round_even(sum(p * w), 0)::INT AS p FROM across JOIN wy ON wy.a = across.y GROUP BY ALL",
}

# Another way to the same rows.
ORACLES["pyramid_refresh"] = ORACLES["octree_pyramid"]
ORACLES["node_rates_stream"] = ORACLES["node_rates"]
