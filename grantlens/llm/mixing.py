"""Mixing sources to target weights (native).

Words are packed into fixed-length blocks, source by source. The output is cut into shards of SHARD_SLOTS slots. Each
slot draws its source, with the sources' shares of all slots, from a hash of its place; the counts of a shard are so a
multinomial draw. A source's slots are numbered shard after shard. Draws over a source's number of slots (a few in the
order of the square root of it) go to the sources that fell short, so totals are exact and no source passes its cap.
Slot j of a source takes the block that the source's own index permutation gives for j, pass after pass, and blocks are
joined by index.

Defined results for odd input: a null text or one without words has size 0 and nothing is taken from it; null sources
are one source, last in order; rows repeated in all columns are separate documents; null ids are documents of their
own; an empty table gives an empty result; columns beside doc_id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import boxed, prefix_sums, ranged, saved, unboxed

WORD = r"[^\x20\x09-\x0D]+"
#: Words in a block, slots in an output shard, most passes over a source.
BLOCK = 64
SHARD_SLOTS = 1024
PASSES = 3
#: Shards in one bucket of the prefix sums.
SHARD_BUCKET = 1024
#: Ranges of slots that draws are looked up in, about, and slots that a task of the generator makes.
LOOKUPS, TASK_SLOTS = 1024, 1 << 18


def stride(n: str, salt: str) -> str:
    """A multiplier without a common factor with n: one of three primes that doesn't divide it, dealt by salt."""
    a, b, c = "1000003", "1000033", "1000037"
    return f"(CASE WHEN {n} % {a} <> 0 AND ({salt}) % 2 = 0 THEN {a} WHEN {n} % {b} <> 0 THEN {b} WHEN {n} % {a} <> 0 THEN {a} ELSE {c} END)"


def permuted(x: str, n: str, seed: str, round_: int) -> str:
    """SQL of one round of a permutation of 0..n-1; n < 9e12. Four rounds make the permutation (see ROUNDS).

    Rounds 0 and 3 turn all of the range by an affine map. Rounds 1 and 2 turn only its first or last two thirds,
    which breaks the lattice that a single affine map leaves. Each round is one-to-one, so their product is.
    """
    part = f"(({n} * 2 + 2) DIV 3)"
    if round_ in (0, 3):
        return f"(({x} * {stride(n, f'{seed} + {round_}')} + ({seed} + 1) * {7919 + 1000 * round_}) % {n})"
    if round_ == 1:
        return f"(CASE WHEN {x} < {part} THEN ({x} * {stride(part, seed)} + ({seed} + 1) * 104729) % {part} ELSE {x} END)"
    return f"(CASE WHEN {x} >= {n} - {part} THEN {n} - {part} + (({x} - {n} + {part}) * {stride(part, seed)} + ({seed} + 1) * 15485863) % {part} ELSE {x} END)"


ROUNDS = 4


def permute(df: DataFrame, x: str, n: str, seed: str, out: str) -> DataFrame:
    df = df.withColumn(out, F.expr(x))
    for r in range(ROUNDS):
        df = df.withColumn(out, F.expr(permuted(out, n, seed, r)))
    return df


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, skey (the source as a sort key: null last), size in words."""
    skey = F.when(F.col("source").isNull(), "2").otherwise(F.concat(F.lit("1"), F.col("source")))
    return docs.select("doc_id", skey.alias("skey"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def known_sources(rows: DataFrame) -> DataFrame:
    """targets(), one row a source, as a table of its own."""
    return saved(targets(rows), "targets")


def targets(rows: DataFrame) -> DataFrame:
    """By source: source_size, target, n_blocks, passes, extra (blocks of the last, partial pass), first slot, slots.

    Targets share all words by weight 1, 2, 3, 1, 2, 3 ..., but stop at PASSES times the source. The level at which
    the uncapped sources stand is found by one sort of the sources, by size over weight, instead of by rounds.
    """
    one = F.lit(0)
    s = rows.groupBy("skey").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("rank", F.row_number().over(Window.partitionBy(one).orderBy("skey")) - 1)
    s = s.withColumn("weight", F.col("rank") % 3 + 1)
    s = s.withColumn("cap", F.lit(float(PASSES)) * F.col("source_size"))
    every = Window.partitionBy(one)
    up = every.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    since = up.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(since))
    # the first source in that order that the level leaves under its cap gives the level of all uncapped ones
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.row_number().over(up).alias("nth"), F.col("level")))
    s = s.withColumn("fits", fits).withColumn("level", F.coalesce(F.min("fits").over(every)["level"], F.lit(0.0)))
    s = s.withColumn("target", F.least(F.col("cap"), F.col("level") * F.col("weight")))
    s = s.withColumn("n_blocks", F.ceil(F.col("source_size") / BLOCK))
    s = s.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    s = s.withColumn("extra", F.least("n_blocks", F.round((F.col("target") - F.col("passes") * F.col("source_size")) / BLOCK).cast("long")))
    s = s.withColumn("slots", F.col("passes") * F.col("n_blocks") + F.col("extra"))
    s = s.withColumn("first_slot", F.coalesce(F.sum("slots").over(every.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return s.drop("cap", "level", "fits")


def draws(sources: DataFrame) -> DataFrame:
    """shard, skey, n: the source counts of each output shard, one multinomial draw a shard.

    A slot's hash picks one of all slots, laid out source by source; the picked one's source is found by an equal key,
    the range of slots that it lies in.
    """
    spark = sources.sparkSession
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    width = max(1, -(-total // LOOKUPS))
    places = spark.range(0, total, 1, max(1, -(-total // TASK_SLOTS))).select(F.expr(f"id DIV {SHARD_SLOTS}").alias("shard"), F.expr(picked("id", max(1, total))).alias("pick"))
    held = sources.filter("slots > 0").withColumn("lookup", F.explode(F.expr(f"sequence(first_slot DIV {width}L, (first_slot + slots - 1) DIV {width}L)")))
    held = saved(held.select("lookup", "skey", "first_slot", (F.col("first_slot") + F.col("slots")).alias("past")), "lookups")  # LOOKUPS rows and one a source
    met = places.withColumn("lookup", F.expr(f"pick DIV {width}L")).join(held, "lookup").filter("pick >= first_slot AND pick < past")
    return met.groupBy("shard", "skey").agg(F.count("*").alias("n"))


def picked(place: str, total: int) -> str:
    """SQL: a pseudorandom number below total for a place, from 48 bits of its MD5."""
    return f"cast(conv(substring(md5(cast({place} as string)), 1, 12), 16, 10) as bigint) % {total}L"


def deck(sources: DataFrame, counts: DataFrame) -> DataFrame:
    """One row a slot: shard, skey, pass and block. counts: draws()."""
    counts = counts.withColumn("bucket", F.expr(f"shard DIV {SHARD_BUCKET}"))
    firsts = prefix_sums(counts, ["skey"], "bucket", [F.col("shard")], F.col("n"), "first").select("shard", F.col("skey").alias("drawn_key"), "first", "n")
    drawn = counts.groupBy("skey").agg(F.sum("n").alias("drawn"))
    known = sources.select("skey", "rank", "n_blocks", "slots").join(drawn, "skey", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    known = known.withColumn("over", F.expr("greatest(drawn - slots, 0L)")).withColumn("short", F.expr("greatest(slots - drawn, 0L)"))
    ahead = Window.partitionBy(F.lit(0)).orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)  # one row a source
    known = saved(known.withColumn("over_from", F.coalesce(F.sum("over").over(ahead), F.lit(0))).withColumn("short_from", F.coalesce(F.sum("short").over(ahead), F.lit(0))), "drawn")
    # a number of partitions that is named isn't folded: few small rows become very many slots
    firsts = firsts.repartition(int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard", "drawn_key")
    slots = firsts.join(known, F.col("drawn_key") == F.col("skey")).withColumn("j", F.explode(F.expr("sequence(first, first + n - 1)")))
    spare = slots.filter("j >= slots").select("shard", F.expr("over_from + j - slots").alias("nth"))
    lacking = known.filter("short > 0").withColumn("j", F.explode(F.expr("sequence(drawn, slots - 1)")))
    lacking = lacking.select(F.expr("short_from + j - drawn").alias("nth"), "skey", "rank", "n_blocks", "j")
    every = slots.filter("j < slots").select("shard", "skey", "rank", "n_blocks", "j").unionByName(spare.join(lacking, "nth").select("shard", "skey", "rank", "n_blocks", "j"))
    return permute(every.withColumn("pass", F.expr("j DIV n_blocks")), "j % n_blocks", "n_blocks", "rank", "block").select("shard", "skey", "pass", "block")


def takings(sources: DataFrame) -> DataFrame:
    """skey, block, times, first_shard: how often the output shards take a block, and the first that does."""
    slots = deck(sources, saved(draws(sources), "draws"))
    return slots.groupBy("skey", "block").agg(F.count("*").alias("times"), F.min("shard").alias("first_shard"))


def laid_out(rows: DataFrame) -> DataFrame:
    """Adds start: the document's first word in its source's sequence of words, in the order of ids."""
    rows = ranged(rows, ["skey", "doc_id", "size"], "bucket", "layout")
    return prefix_sums(rows, ["skey"], "bucket", [F.col("doc_id"), F.col("size")], F.col("size"), "start")


def pieces(rows: DataFrame) -> DataFrame:
    """One row for each block that a document has words in: skey, block, lo and hi (its words in the block, from its own 0)."""
    some = rows.filter("size > 0").withColumn("block", F.explode(F.expr(f"sequence(start DIV {BLOCK}, (start + size - 1) DIV {BLOCK})")))
    return some.withColumn("lo", F.expr(f"greatest(0L, block * {BLOCK} - start)")).withColumn("hi", F.expr(f"least(size, (block + 1) * {BLOCK} - start)"))


def mixed(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and first_shard (the first output shard that takes of it) of every row of docs."""
    rows = saved(sized(docs), "sizes")
    sources = known_sources(rows)
    rows = laid_out(rows)
    own = ["skey", "bucket", "n_before"]
    got = pieces(rows).join(takings(sources).hint("merge"), ["skey", "block"]).groupBy(*own).agg(F.sum(F.expr("(hi - lo) * times")).alias("taken"), F.min("first_shard").alias("first_shard"))
    # slots come from a few source rows, which would pass for a small table: these joins must not broadcast them
    got = got.select(*[F.col(c).alias(f"g_{c}") for c in own], "taken", "first_shard").hint("merge")
    rows = rows.join(got, [F.col(c).eqNullSafe(F.col(f"g_{c}")) for c in own], "left")
    rows = rows.join(sources.select("skey", "source_size", "target"), "skey")
    return rows.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_shard")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mixture as documents: for each pass, a document's words in the blocks that the mix takes at least so often.

    Columns of docs stay; text is the text, or, where only some blocks are taken, their words space-joined; n_chars is
    its length. A document of which nothing is taken doesn't appear.
    """
    rows = saved(sized(docs), "sizes")
    taken = takings(known_sources(rows)).drop("first_shard")
    # equal (skey, doc_id, size) rows lie next to each other in the layout, so numbering them by text keeps the layout
    spans = pieces(laid_out(rows)).join(taken.hint("merge"), ["skey", "block"])
    spans = spans.withColumn("pass", F.explode(F.expr("sequence(1, cast(times as int))")))
    per = spans.groupBy("skey", "doc_id", "size", "bucket", "n_before", "pass").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans"))
    per = per.groupBy("skey", "doc_id", "size", "bucket", "n_before").agg(F.collect_list(F.struct("pass", "spans")).alias("takes"))
    same = Window.partitionBy("skey", "doc_id", "size")
    per = per.withColumn("copy", F.row_number().over(same.orderBy("n_before")))
    raw = boxed(docs).withColumn("source_key", F.when(F.col("box_source").isNull(), "2").otherwise(F.concat(F.lit("1"), F.col("box_source"))))
    raw = raw.withColumn("words", F.coalesce(F.regexp_count("box_text", F.lit(WORD)), F.lit(0)).cast("long")).filter("words > 0")
    raw = raw.withColumn("own_copy", F.row_number().over(Window.partitionBy("source_key", "box_doc_id", "words").orderBy("box_text")))
    out = raw.join(per.hint("merge"), (F.col("source_key") == F.col("skey")) & F.col("box_doc_id").eqNullSafe(F.col("doc_id")) & (F.col("words") == F.col("size")) & (F.col("own_copy") == F.col("copy")))
    out = out.withColumn("parts", F.regexp_extract_all("box_text", F.lit(WORD), F.lit(0))).withColumn("take", F.explode("takes"))
    some = "array_join(flatten(transform(take.spans, p -> slice(parts, cast(p.lo + 1 as int), cast(p.hi - p.lo as int)))), ' ')"
    whole = "aggregate(take.spans, 0L, (n, p) -> n + p.hi - p.lo) = words"
    return unboxed(out, docs, text=F.expr(f"if({whole}, box_text, {some})"))
