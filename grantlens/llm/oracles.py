"""DuckDB SQL for the queries that SQL can express.

The others have none: CRC-32 (op5, op10), XXH64 (op9) and tokenization (op2, op12) aren't in SQL; models (op4, op8), graph
search (op6), alignment (op1) and eigenvectors (op13) are procedures. Tests hold those against plain versions.
"""

from __future__ import annotations

from . import mixing, secrets, vacode, vectors


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _secrets() -> str:
    kinds = []
    for rank, (kind, (_, pattern, least, group)) in enumerate(secrets.RULES.items()):
        p = _quoted(pattern)
        kinds.append(f"SELECT doc_id, {rank} AS rank, '{kind}' AS kind, {least} AS least, string_split_regex(x, {p}) AS gaps, regexp_extract_all(x, {p}, 0) AS hits, regexp_extract_all(x, {p}, {group}) AS counted FROM t")
    base = ", ".join(f"'{k}'" for k in secrets.BASE)
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
k AS ({" UNION ALL ".join(kinds)}),
one AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM k),
placed AS (SELECT doc_id, rank, kind, least, length(counted[i]) AS counted, length(hits[i]) AS n,
  list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda g: length(g))), 0) AS start FROM one),
kept AS (SELECT *, kind || ':' || start::BIGINT || ':' || (start + n)::BIGINT AS span FROM placed WHERE counted >= least),
per AS (SELECT doc_id, string_agg(span, ',' ORDER BY start, rank) AS spans, string_agg(span, ',' ORDER BY start, rank) FILTER (kind IN ({base})) AS base,
  count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS b, count(*) FILTER (kind = 'hex') AS c FROM kept GROUP BY doc_id)
SELECT t.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN per ON t.doc_id = per.doc_id"""


def _rounds(source: str, x: str, n: str, seed: str, name: str) -> str:
    """CTEs that carry x through the permutation's rounds: name0 to name<ROUNDS>."""
    out = [f"{name}0 AS (SELECT *, ({x})::BIGINT AS v FROM {source})"]
    for r in range(mixing.ROUNDS):
        step = mixing.permuted("v", n, seed, r).replace(" DIV ", " // ")
        out.append(f"{name}{r + 1} AS (SELECT * REPLACE (({step})::BIGINT AS v) FROM {name}{r})")
    return ",\n".join(out)


def _mixing() -> str:
    b, passes = mixing.BLOCK, mixing.PASSES
    return f"""
WITH rows AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, row_number() OVER () AS rid FROM rows),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM rows GROUP BY source),
w AS (SELECT *, rank % 3 + 1 AS weight, {passes} * source_size AS cap FROM s),
marks AS (SELECT m.cap / m.weight AS mark, sum(least(w.cap, m.cap / m.weight * w.weight)) AS filled FROM w m, w GROUP BY m.source, m.cap, m.weight),
least_mark AS (SELECT min(mark) AS mark FROM marks WHERE filled >= (SELECT sum(source_size) FROM w) - 1e-6),
level AS (SELECT ((SELECT sum(source_size) FROM w) - coalesce(sum(cap) FILTER (cap / weight < mark), 0)) / sum(weight) FILTER (cap / weight >= mark) AS level FROM w, least_mark),
t AS (SELECT *, least(cap, level * weight)::DOUBLE AS target, ceil(source_size / {b})::BIGINT AS n_blocks FROM w, level),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM t),
e AS (SELECT *, passes * n_blocks + least(n_blocks, round((target - passes * source_size) / {b})::BIGINT) AS slots FROM q),
f AS (SELECT *, coalesce(sum(slots) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_slot FROM e),
places AS (SELECT g, g // {mixing.SHARD_SLOTS} AS shard, ('0x' || substr(md5(g::VARCHAR), 1, 12))::BIGINT % (SELECT sum(slots)::BIGINT FROM e) AS pick FROM (SELECT unnest(range((SELECT sum(slots)::BIGINT FROM e))) AS g)),
drawn AS (SELECT f.*, shard, row_number() OVER (PARTITION BY rank ORDER BY shard, g) - 1 AS j FROM places JOIN f ON pick >= first_slot AND pick < first_slot + f.slots),
totals AS (SELECT f.*, coalesce(n, 0) AS n FROM f LEFT JOIN (SELECT rank, count(*) AS n FROM drawn GROUP BY rank) c ON f.rank = c.rank),
spare AS (SELECT shard, row_number() OVER (ORDER BY rank, j) AS nth FROM drawn WHERE j >= slots),
lacking AS (SELECT *, row_number() OVER (ORDER BY rank, j) AS nth FROM (SELECT source, rank, n_blocks, unnest(range(n, slots::BIGINT)) AS j FROM totals WHERE slots > n)),
slots AS (SELECT source, rank, n_blocks, shard, j FROM drawn WHERE j < slots UNION ALL SELECT source, rank, n_blocks, shard, j FROM spare JOIN lacking ON spare.nth = lacking.nth),
{_rounds("slots", "j % n_blocks", "n_blocks", "rank", "p")},
taken AS (SELECT source, v AS block, count(*) AS times, min(shard) AS first_shard FROM p{mixing.ROUNDS} GROUP BY source, v),
pieces AS (SELECT rid, source, start, size, unnest(range((start // {b})::BIGINT, ((start + size - 1) // {b})::BIGINT + 1)) AS block FROM placed WHERE size > 0),
got AS (SELECT p.rid, sum((least(p.start + p.size, (p.block + 1) * {b}) - greatest(p.start, p.block * {b})) * t.times)::BIGINT AS taken, min(first_shard) AS first_shard FROM pieces p JOIN taken t ON p.block = t.block AND p.source IS NOT DISTINCT FROM t.source GROUP BY p.rid)
SELECT r.doc_id, r.size, e.source_size, round(e.target, 6) AS target, coalesce(g.taken, 0) AS taken, g.first_shard FROM placed r JOIN e ON r.source IS NOT DISTINCT FROM e.source LEFT JOIN got g ON r.rid = g.rid"""


def _vacode() -> str:
    """Plain sums over all entries; distances as products of doubles, which hold these whole numbers exactly."""
    p, n, scale = vacode.PARTS, vacode.ENTRIES, vectors.SCALE
    rounds = [f"""
e0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id, rid) - 1 AS entry, v FROM parts QUALIFY entry < {n})"""]
    near = """SELECT rid, part, min(entry) FILTER (d = least) AS entry, min(least) AS d FROM (SELECT *, min(d) OVER (PARTITION BY rid, part) AS least FROM (
  SELECT p.rid, p.part, e.entry, list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, e.v) + list_inner_product(e.v, e.v) AS d FROM parts p JOIN {e} e ON p.part = e.part)) GROUP BY rid, part"""
    for r in range(vacode.ROUNDS):
        rounds.append(f"""
n{r} AS MATERIALIZED ({near.format(e=f"e{r}")}),
s{r} AS (SELECT n.part, n.entry, i, sum(p.v[i])::HUGEINT AS s, count(*)::HUGEINT AS n FROM n{r} n JOIN parts p ON n.rid = p.rid AND n.part = p.part, (SELECT unnest(range(1, (SELECT max(len(v)) FROM parts) + 1)) AS i) GROUP BY n.part, n.entry, i),
m{r} AS (SELECT part, entry, list(((s - (s % n + n) % n) // n)::DOUBLE ORDER BY i) AS v FROM s{r} GROUP BY part, entry),
e{r + 1} AS MATERIALIZED (SELECT e.part, e.entry, coalesce(m.v, e.v) AS v FROM e{r} e LEFT JOIN m{r} m ON e.part = m.part AND e.entry = m.entry)""")
    last = vacode.ROUNDS
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, list_transform(embedding, lambda c: floor({scale} * c::DOUBLE)) AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
parts AS MATERIALIZED (SELECT rid, vec_id, part, x[(part * len(x) // {p} + 1)::BIGINT:((part + 1) * len(x) // {p})::BIGINT] AS v FROM kept, (SELECT unnest(range({p})) AS part)),{",".join(rounds)},
n{last} AS MATERIALIZED ({near.format(e=f"e{last}")}),
coded AS (SELECT rid, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM n{last} GROUP BY rid),
rows AS (SELECT k.vec_id, k.label, c.code, c.error FROM kept k JOIN coded c ON k.rid = c.rid),
books AS (SELECT sha256(string_agg(list_aggregate(list_transform(v, lambda c: c::BIGINT::VARCHAR), 'string_agg', ','), ',' ORDER BY part, entry)) AS digest FROM e{last})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, digest AS codebooks_sha256 FROM rows, books"""


ORACLES: dict[str, str] = {"op3_mixing": _mixing(), "op7_secrets": _secrets(), "op11_vacode": _vacode()}
