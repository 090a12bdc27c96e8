"""Entity resolution against a dimension: candidates by equal keys, disambiguation, fuzzy matches with margins.

A dimension has canonical_id, name, state, city, entity_class and pos (its row order; an id's first row is shown). Names
to resolve have qid, name, city, state, one row each. Joins are on equal keys throughout: names, prefixes, states, rare
grams and tokens. Fuzzy scores are computed once a distinct pair, for pairs that may reach the floor (see alike).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..functions.lineage import cut, merged
from ..functions.numbering import first_rows
from ..functions.similarity import scores
from .alike import candidates
from .anchors import first_rule

HOME_CLASSES = ("IPEDS-US", "non-IPEDS-US")


def prepared(dim: DataFrame) -> DataFrame:
    """The dimension with match columns: norm_name, prefix (what stands before the first dash), up_state, norm_city, office, seat."""
    name = text.norm(F.col("name"))
    return dim.filter("canonical_id IS NOT NULL AND canonical_id NOT IN ('', 'NA', 'NCI')").select(
        "canonical_id", "name", "entity_class", "pos",
        name.alias("norm_name"),
        F.when(F.instr("name", "-") > 0, text.norm(F.substring_index("name", "-", 1))).alias("prefix"),
        F.upper(F.coalesce("state", F.lit(""))).alias("up_state"),
        text.norm(F.col("city")).alias("norm_city"),
        F.upper("name").rlike(fixed.OFFICES).alias("office"),
        name.contains(fixed.SEAT_WORDS).alias("seat"),
    )


def shown(dim: DataFrame) -> DataFrame:
    """Each id's first row."""
    return first_rows(dim, ["canonical_id"], "pos")


def next_surrogate(dim: DataFrame, prefix: str = "SG") -> DataFrame:
    """One row: the largest surrogate number in use."""
    return dim.agg(F.coalesce(F.max(F.regexp_extract("canonical_id", rf"^{prefix}(\d+)$", 1).try_cast("long")), F.lit(0)).alias("top"))


def _pools(tests: dict[str, Column]) -> list[Column]:
    """For each test, among members that are no offices and among all: how many pass, and the least id of those."""
    found = []
    for pool, member in (("real", ~F.col("office")), ("all", F.lit(True))):
        for name, test in tests.items():
            found += [F.count_if(member & test).alias(f"{pool}_{name}_n"), F.min(F.when(member & test, F.col("canonical_id"))).alias(f"{pool}_{name}")]
    return found


def _decided() -> Column:
    """The id that stands out, from _pools() of any, state, city, seat and state_seat; counts that are null are 0."""

    def among(pool: str) -> Column:
        only = lambda test: F.when(F.col(f"{pool}_{test}_n") == 1, F.col(f"{pool}_{test}"))
        seats = F.when(F.col(f"{pool}_state_n") > 0, only("state_seat")).otherwise(only("seat"))
        return F.coalesce(only("any"), only("city"), only("state"), seats)

    return F.when(F.col("real_any_n") > 0, among("real")).otherwise(among("all"))


def pick(asked: DataFrame, members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """asked, with the canonical_id of the member of its keys that stands out; rows without one go.

    Offices drop out if others remain. Then: a single one; the only one in the city and state; the only one in the
    state; the only seat in the state, or anywhere if the state has none. asked: keys, q_state, q_city. members: keys,
    canonical_id (distinct by key), office, seat, up_state, norm_city.

    All of that needs counts of a key's members only, by key, state and city. They are taken once, so no row of asked
    ever meets a key's members one by one, however many share the key.
    """
    every, keys = F.lit(True), list(keys)
    by_key = members.groupBy(*keys).agg(*_pools({"any": every, "seat": F.col("seat")}))
    placed = members.filter("up_state <> ''")
    by_state = placed.groupBy(*keys, F.col("up_state").alias("q_state")).agg(*_pools({"state": every, "state_seat": F.col("seat")}))
    by_city = placed.filter("norm_city <> ''").groupBy(*keys, F.col("up_state").alias("q_state"), F.col("norm_city").alias("q_city")).agg(*_pools({"city": every}))
    met = asked.join(merged(by_key), keys).join(merged(by_state), [*keys, "q_state"], "left").join(merged(by_city), [*keys, "q_state", "q_city"], "left")
    return met.withColumn("canonical_id", _decided()).filter("canonical_id IS NOT NULL").select(*asked.columns, "canonical_id")


def _rules(rules: DataFrame, extra: dict[str, Column], out: str) -> DataFrame:
    """Rule rows by normalised key (k_<out>) and extra columns, one a key: the least id of equals."""
    rows = rules.select(text.norm(text.strip_wrappers(F.col("key"))).alias(f"k_{out}"), *[c.alias(n) for n, c in extra.items()], F.col("id"))
    return rows.groupBy(f"k_{out}", *extra).agg(F.min("id").alias(out))


def federation(members: dict[str, Sequence[str]], shared: Sequence[str], ids: dict[str, str]) -> list[tuple[str, str]]:
    """(key, id) rules for colleges of federations. members: a seat's colleges that no other has; shared: names that others
    have too, which count only with the seat's name behind them; ids: the federation's id by seat."""
    alone = [(name, ids[seat]) for seat, names in members.items() for name in names]
    return alone + [(f"{name} {seat}", ident) for name in shared for seat, ident in ids.items()]


def overrides(names: DataFrame, by_state: DataFrame, by_city: DataFrame, by_name: DataFrame, contains: Sequence[tuple[str, Sequence[str], str]] | DataFrame = (), by_member: DataFrame | None = None) -> DataFrame:
    """qid, canonical_id from rule tables, the most specific first: (key, state, id), (key, city, id), (key, id), by_member
    (key, id: colleges of a federation), then (must, excludes, id) in order: the first whose text stands in the name, and
    none of its exclusions, wins. A long list of those is a table (rule_no, must, excludes, id), which an automaton reads.

    Rule keys are normalised like names, so a rule can't miss by its spelling. Whether rule tables are broadcast is
    left to their size.
    """
    rows = names.select("qid", text.norm(text.strip_wrappers(F.col("name"))).alias("g"), F.upper(F.coalesce("state", F.lit(""))).alias("s"), text.norm(F.col("city")).alias("c"))
    a = _rules(by_state, {"rule_state": F.upper("state")}, "id_state")
    b = _rules(by_city, {"rule_city": text.norm(F.col("city"))}, "id_city")
    c = _rules(by_name, {}, "id_name")
    rows = rows.join(a, (F.col("g") == F.col("k_id_state")) & (F.col("s") == F.col("rule_state")), "left")
    rows = rows.join(b, (F.col("g") == F.col("k_id_city")) & (F.col("c") == F.col("rule_city")), "left")
    rows = rows.join(c, F.col("g") == F.col("k_id_name"), "left")
    if by_member is None:
        rows = rows.withColumn("id_member", F.lit(None).cast("string"))
    else:
        rows = rows.join(_rules(by_member, {}, "id_member"), F.col("g") == F.col("k_id_member"), "left")
    if isinstance(contains, DataFrame):
        last = F.col("id_rule")
        rows = rows.join(first_rule(rows.select("g").distinct(), "g", "g", contains).withColumnsRenamed({"g": "k_id_rule", "id": "id_rule"}), F.col("g") == F.col("k_id_rule"), "left")
    else:
        last = contains_rule(F.col("g"), contains)
    return rows.select("qid", F.coalesce("id_state", "id_city", "id_name", "id_member", last).alias("canonical_id")).filter("canonical_id IS NOT NULL")


def contains_rule(c: Column, rules: Sequence[tuple[str, Sequence[str], str]]) -> Column:
    """The id of the first rule (must, excludes, id) that fits, or null. Rules are a short, fixed list, so no join is needed."""
    return F.coalesce(*[F.when(c.contains(must) & ~text.contains_any(c, excludes), F.lit(id_)) for must, excludes, id_ in rules], F.lit(None).cast("string"))


def exact(names: DataFrame, dim: DataFrame) -> DataFrame:
    """qid, canonical_id, tier: by name and state, by name, by prefix, first for the normalised and then for the stripped name.

    All six look-ups are one join of probes with an index of keys; the least tier that is decided wins.
    """
    d = prepared(dim)
    keyed = F.array(
        F.struct(F.lit("ns").alias("kind"), F.concat_ws("|", "norm_name", "up_state").alias("key")),
        F.struct(F.lit("n").alias("kind"), F.col("norm_name").alias("key")),
        F.struct(F.lit("p").alias("kind"), F.col("prefix").alias("key")),
    )
    index = d.select("canonical_id", F.explode(keyed).alias("k")).select("canonical_id", "k.kind", "k.key").filter("key IS NOT NULL AND key <> ''").distinct()
    info = first_rows(d.select("canonical_id", "office", "seat", "up_state", "norm_city", "pos"), ["canonical_id"], "pos").drop("pos")
    index = index.join(merged(info), "canonical_id")
    state = F.upper(F.coalesce("state", F.lit("")))
    q = names.select("qid", text.norm(F.col("name")).alias("q0"), text.strip_wrappers(F.col("name")).alias("q1"), state.alias("q_state"), text.norm(F.col("city")).alias("q_city"))
    probes = []
    for i, col in enumerate(("q0", "q1")):
        probes += [
            F.struct(F.lit(3 * i + 1).alias("tier"), F.lit("ns").alias("kind"), F.concat_ws("|", col, "q_state").alias("key"), F.col(col).alias("q")),
            F.struct(F.lit(3 * i + 2).alias("tier"), F.lit("n").alias("kind"), F.col(col).alias("key"), F.col(col).alias("q")),
            F.struct(F.lit(3 * i + 3).alias("tier"), F.lit("p").alias("kind"), F.col(col).alias("key"), F.col(col).alias("q")),
        ]
    asked = q.select("qid", "q_state", "q_city", F.explode(F.array(*probes)).alias("x")).select("qid", "q_state", "q_city", "x.*").filter("q <> ''").drop("q")
    found = pick(asked, index, ["kind", "key"])
    return found.groupBy("qid").agg(F.min_by("canonical_id", "tier").alias("canonical_id"), F.min("tier").alias("tier"))


def margins(scored: DataFrame, key: str, floor: float, margin: float) -> DataFrame:
    """key, canonical_id, top, second, accepted, from key, canonical_id, score: the best id if it is good enough and ahead of every other id.

    The two best scores of an id each come from one aggregate: the largest struct, and the largest of the others.
    """
    best = scored.groupBy(key, "canonical_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy(key).orderBy(F.desc("score"), F.desc("canonical_id"))
    two = best.withColumn("nth", F.row_number().over(w)).filter("nth <= 2")
    out = two.groupBy(key).agg(F.max(F.when(F.col("nth") == 1, F.col("canonical_id"))).alias("canonical_id"), F.max("score").alias("top"), F.coalesce(F.max(F.when(F.col("nth") == 2, F.col("score"))), F.lit(0.0)).alias("second"))
    return out.withColumn("accepted", (F.col("top") >= floor) & (F.col("top") - F.col("second") >= margin))


def shares_token(a: Column, b: Column, common: Sequence[str] = fixed.COMMON_TOKENS) -> Column:
    """Whether two normalised names share a distinctive token."""
    return F.arrays_overlap(text.distinctive_tokens(a, common), text.distinctive_tokens(b, common))


def national(names: DataFrame, dim: DataFrame, floor: float = 93, margin: float = 10, least: int = 10, common: Sequence[str] = fixed.COMMON_TOKENS, classes: Sequence[str] | None = HOME_CLASSES) -> DataFrame:
    """qid with margins() columns, by token-set similarity to names anywhere. names: qid, q (normalised). Short and one-word names don't qualify."""
    d = prepared(dim)
    if classes is not None:
        d = d.filter(F.col("entity_class").isin(*classes))
    fit = names.filter((F.length("q") >= least) & F.col("q").contains(" "))
    pairs = candidates(fit, d.select(F.col("norm_name").alias("n")), "token_set", floor).filter(shares_token(F.col("q"), F.col("n"), common))
    pairs = pairs.withColumn("score", scores("token_set")("q", "n")).filter(F.col("score") >= floor)
    scored = merged(pairs).join(merged(d.select(F.col("norm_name").alias("n"), "canonical_id").distinct()), "n")
    return fit.select("qid", "q").join(merged(margins(scored, "q", floor, margin)), "q")


def in_state(names: DataFrame, dim: DataFrame, kind: str, floor: float, margin: float, least: int = 6) -> DataFrame:
    """qid with margins() columns, by similarity to names in the same state. names: qid, q, q_state."""
    d = prepared(dim).select(F.col("up_state").alias("q_state"), F.col("norm_name").alias("n"), "canonical_id").distinct()
    fit = names.filter((F.length("q") >= least) & (F.col("q_state") != ""))
    pairs = candidates(fit, d, kind, floor, ["q_state"])
    pairs = pairs.withColumn("score", scores(kind)("q", "n")).filter(F.col("score") >= floor)
    scored = merged(pairs).join(merged(d), ["q_state", "n"]).withColumn("key", F.concat_ws("\x01", "q", "q_state"))
    return fit.withColumn("key", F.concat_ws("\x01", "q", "q_state")).join(merged(margins(scored, "key", floor, margin)), "key").drop("key")


def has_similar(names: DataFrame, dim: DataFrame, floor: float = 85) -> DataFrame:
    """qid of names that resemble one in their state. names: qid, q, q_state."""
    return in_state(names, dim, "token_set", floor, 0, least=0).select("qid").distinct()


def cascade(names: DataFrame, dim: DataFrame, rules: dict[str, DataFrame] | None = None, save=cut) -> DataFrame:
    """qid, canonical_id, decided_by; each tier sees only what the ones before left open.

    save: cuts lineage between tiers (a function of a DataFrame), so that no tier is computed twice.
    """
    out = []
    left = names

    def settle(found: DataFrame, tier: str) -> None:
        nonlocal left
        found = save(found.select("qid", "canonical_id", F.lit(tier).alias("decided_by")))
        out.append(found)
        left = left.join(merged(found.select("qid")), "qid", "left_anti")

    if rules:
        settle(overrides(left, **rules), "override")
    settle(exact(left, dim), "exact")
    q = left.select("qid", text.strip_wrappers(F.col("name")).alias("q"), F.upper(F.coalesce("state", F.lit(""))).alias("q_state"))
    settle(national(q, dim).filter("accepted"), "national")
    for kind, floor, margin in (("token_sort", 92, 6), ("token_set", 95, 8)):
        q2 = q.join(merged(left.select("qid")), "qid", "left_semi")
        settle(in_state(q2, dim, kind, floor, margin).filter("accepted"), f"state_{kind}")
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return names.select("qid").join(merged(found), "qid", "left").withColumn("decided_by", F.coalesce("decided_by", F.lit("unresolved")))
