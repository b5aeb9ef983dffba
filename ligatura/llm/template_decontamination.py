r"""Operator 10: benchmark decontamination by templates, in DataFrame operations only.

Texts become words (runs outside ``[\x20\x09-\x0D]`` that aren't marks alone, stripped of outer marks, lower case).
Words that start with a digit become ``<num>``, unit words ``<unit>``, and capitalised words inside a sentence
``<name>``; hashes of all windows of ``WINDOW`` such words meet the benchmark's in one hash join, so a question with other
numbers, names or units still meets its template. An item of fewer words is one window of its own length; one of fewer
than five words only meets texts of exactly its words. Windows with fewer than two plain words are no evidence.

A document is contaminated by an item if the item's words that lie in common windows are at least half of it, or at least
``MIN_WORDS``, in a run of positions (a diagonal) whose slots are consistent: wherever the item repeats a slot value, the
document repeats its own. Of an inconsistent run those windows count whose words are the item's own. The benchmark's
windows are broadcast only when they are at most ``BROADCAST_WINDOWS`` (some tens of megabytes), else both sides are
shuffled by hash.

Nulls and edge cases: a null text has no words and is clean; a null item is ignored, as is one without plain words; a very
long text is read whole; documents are told apart by (doc_id, hash of the text), so repeated rows get equal rows of the
result, and rows of one id with other texts their own; items of equal coverage are all listed; an empty benchmark leaves
all clean; an empty table gives no rows; other columns are ignored by ``flag`` and kept by ``remove``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ligatura.llm.common import scratch, table, written

WINDOW = 8
MIN_WORDS = 13
MIN_SHARE = 0.5
BROADCAST_WINDOWS = 1_000_000
#: Marks that are stripped from both ends of a word.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" + "".join(map(chr, (0xA1, 0xAB, 0xB7, 0xBB, 0xBF, *range(0x2010, 0x2028), 0x2030, *range(0x2039, 0x203B))))
#: Words that name a unit.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ounce ounces ton tons "
    "ml l litre litres liter liters gallon gallons second seconds sec minute minutes min hour hours hr day days week weeks month months year years "
    "dollar dollars cent cents euro euros usd eur percent degree degrees celsius fahrenheit mph kmh watt watts volt volts"
).split()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text as (raw, bare); line ends also end a sentence."""
    cut = F.split(F.replace(text, F.lit("\n"), F.lit(". ")), r"[\x20\x09-\x0D]+")
    pairs = F.transform(cut, lambda w: F.named_struct(F.lit("raw"), w, F.lit("bare"), F.lower(F.btrim(w, F.lit(MARKS)))))
    return F.coalesce(F.filter(pairs, lambda p: p["bare"] != ""), F.array().cast("array<struct<raw:string,bare:string>>"))


def template(tokens: Column, names: bool = True) -> Column:
    """The words with typed placeholders; without ``names`` capitalised words stay words."""

    def one(t: Column, i: Column) -> Column:
        # the cheap test comes first: only words with a capital meet the regular expressions
        named = (i > 0) & (F.lower(t["raw"]) != t["raw"]) & t["raw"].rlike(r"^[^\p{L}\p{N}]*\p{Lu}\p{Ll}+") & ~F.get(tokens, i - 1)["raw"].rlike(r"[.!?:][^\p{L}\p{N}]*$")
        first = F.substring(t["bare"], 1, 1)
        typed = F.when((first >= "0") & (first <= "9"), F.lit("<num>")).when(t["bare"].isin(UNITS), F.lit("<unit>"))
        return (typed.when(named, F.lit("<name>")) if names else typed).otherwise(t["bare"])

    return F.transform(tokens, one)


def window_hashes(hashes: Column, size: int) -> Column:
    """One hash for each run of ``size`` word hashes."""
    return F.transform(F.sequence(F.lit(1), F.size(hashes) - (size - 1)), lambda i: F.xxhash64(F.slice(hashes, i, size)))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """item_id, tokens and templates of each item with words: with placeholders for names, and with the names as words."""
    cut = benchmark.where("text is not null and item_id is not null").select(F.col("item_id").cast("long"), words(F.col("text")).alias("item_tokens"))
    return cut.where(F.size("item_tokens") > 0).withColumns({"item_template": template(F.col("item_tokens")), "item_named": template(F.col("item_tokens"), names=False)})


def benchmark_windows(items: DataFrame, window: int) -> DataFrame:
    """(wh, size, item_id, item_at, item_words) of every window of the benchmark, under both templates.

    A copy in lower case or capitals shows no names, so it meets the template that has them as words.
    """
    n = F.size("item_template")
    size = F.least(n, F.lit(window))
    plain = lambda a: F.size(F.filter(a, lambda w: ~w.startswith("<")))
    both = F.explode(F.array("item_template", "item_named"))
    at = items.select("item_id", both.alias("words"), n.alias("item_words"), size.alias("size"), F.sequence(F.lit(0), n - size).alias("places"))
    at = at.select("item_id", "words", "item_words", "size", F.explode("places").alias("item_at"))
    part = F.slice("words", F.col("item_at") + 1, F.col("size"))
    kept = at.where(plain(part) >= F.least(F.lit(2), F.col("size")))
    return kept.select(F.xxhash64(F.transform(part, lambda w: F.xxhash64(w))).alias("wh"), "size", "item_id", "item_at", "item_words").distinct()


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and _key, the hash of the text, of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_key"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE) -> DataFrame:
    """(doc_id, _key, item_id, covered, coverage): one row for each document text and item that contaminates it."""
    items = written(benchmark_items(benchmark), "items")
    targets = written(benchmark_windows(items, window), "windows")
    sizes = [r["size"] for r in targets.select("size").distinct().orderBy("size").collect()]  # at most ``window`` values
    ids = keyed(docs)
    empty = F.array().cast("array<struct<size:int,at:int,wh:bigint>>")

    def located(hashes: Column) -> Column:
        def of(size: int) -> Column:
            return F.transform(window_hashes(hashes, size), lambda h, i: F.named_struct(F.lit("size"), F.lit(size), F.lit("at"), i, F.lit("wh"), h))

        return F.concat(empty, *(F.when(F.size(hashes) >= s, of(s)).otherwise(empty) for s in sizes))

    hashed = let(words(F.col("text")), lambda t: F.transform(template(t), lambda w: F.xxhash64(w)))
    found = ids.select("doc_id", "_key", let(hashed, lambda h: F.named_struct(F.lit("n"), F.size(h), F.lit("w"), located(h))).alias("x"))
    found = found.select("doc_id", "_key", F.col("x.n").alias("doc_words"), F.explode("x.w").alias("v")).select("doc_id", "_key", "doc_words", "v.*")
    small = targets.count() <= BROADCAST_WINDOWS
    met = found.join(F.broadcast(targets) if small else targets, ["wh", "size"]).where((F.col("item_words") >= 5) | (F.col("doc_words") == F.col("item_words")))
    runs = met.groupBy("doc_id", "_key", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.max("item_words").alias("item_words"), F.array_sort(F.collect_set(F.struct("item_at", "size"))).alias("at")
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(a["item_at"], a["item_at"] + a["size"] - 1)))))
    runs = written(runs.select("doc_id", "_key", "item_id", "shift", "item_words", covered.alias("covered"), "at"), "runs")  # used twice, computed once
    # only texts that meet a window are read again, for the values in their slots
    slots = runs.join(items, "item_id").where(F.exists("item_template", lambda w: w.startswith("<")))
    asked = slots.groupBy("doc_id", "_key").agg(F.collect_set(F.struct("item_id", "shift", "at", "item_tokens", "item_template")).alias("asks"))
    text = ids.alias("t").join(asked.alias("a"), F.col("t.doc_id").eqNullSafe(F.col("a.doc_id")) & (F.col("t._key") == F.col("a._key"))).select("t.doc_id", "t._key", "text", "asks")
    text = text.dropDuplicates(["doc_id", "_key"]).select("doc_id", "_key", words(F.col("text")).alias("tokens"), F.explode("asks").alias("q"))
    places = F.filter(
        F.array_distinct(F.flatten(F.transform("q.at", lambda a: F.sequence(a["item_at"], a["item_at"] + a["size"] - 1)))),
        lambda p: F.get(F.col("q.item_template"), p).startswith("<"),
    )
    pairs = F.array_distinct(F.transform(places, lambda p: F.named_struct(F.lit("b"), F.get(F.col("q.item_tokens"), p)["bare"], F.lit("d"), F.get(F.col("tokens"), p + F.col("q.shift"))["bare"])))
    odd = F.size(pairs) != F.size(F.array_distinct(F.transform(pairs, lambda s: s["b"])))
    literal = lambda p: F.get(F.col("q.item_tokens"), p)["bare"] == F.get(F.col("tokens"), p + F.col("q.shift"))["bare"]
    same_words = F.filter("q.at", lambda a: F.forall(F.sequence(a["item_at"], a["item_at"] + a["size"] - 1), literal))
    clash = text.where(odd).select("doc_id", "_key", F.col("q.item_id").alias("item_id"), F.col("q.shift").alias("shift"), same_words.alias("same_words"))
    r, c = runs.alias("r"), clash.alias("c")
    same = F.col("r.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("r._key") == F.col("c._key")) & (F.col("r.item_id") == F.col("c.item_id")) & (F.col("r.shift") == F.col("c.shift"))
    good = r.join(c, same, "left").select("r.doc_id", "r._key", "r.item_id", "item_words", F.coalesce("same_words", "at").alias("at")).where(F.size("at") > 0)
    # an inserted or lost word moves the shift, so the consistent runs of an item are taken together
    spots = F.array_distinct(F.flatten(F.collect_list(F.flatten(F.transform("at", lambda a: F.sequence(a["item_at"], a["item_at"] + a["size"] - 1))))))
    total = good.groupBy("doc_id", "_key", "item_id").agg(F.max("item_words").alias("item_words"), F.size(spots).alias("covered"))
    share = F.round(F.col("covered") / F.col("item_words"), 6)
    return total.select("doc_id", "_key", "item_id", F.col("covered").cast("long"), share.alias("coverage")).where((F.col("covered") >= min_words) | (F.col("coverage") >= min_share))


def flag(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids (ascending, comma-joined) and coverage (the best) for every row."""
    with scratch(docs.sparkSession):
        found = written(find_leaks(docs, benchmark), "leaks", keep=True)
    leaks = found.groupBy("doc_id", "_key").agg(
        F.count("*").alias("n_items"), F.array_join(F.transform(F.array_sort(F.collect_set("item_id")), lambda x: x.cast("string")), ",").alias("item_ids"), F.max("coverage").alias("coverage")
    )
    d, k = keyed(docs).drop("text").alias("d"), leaks.alias("k")
    joined = d.join(k, F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d._key") == F.col("k._key")), "left")
    return joined.select(
        "d.doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.lit("")).alias("item_ids"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
    )


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows, with all their columns."""
    with scratch(docs.sparkSession):
        leaks = written(find_leaks(docs, benchmark).select("doc_id", "_key").distinct(), "leaks", keep=True)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    d, k = docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_key")).alias("d"), leaks.alias("k")
    kept = d.join(k, F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d._key") == F.col("k._key")), "left_anti")
    return kept.select("row.*")


def op10_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _words_sql(text: str) -> str:
    marks = MARKS.replace("'", "''")
    return (
        f"list_filter(list_transform(string_split_regex(replace({text}, chr(10), '. '), '[\\x20\\x09-\\x0D]+'), lambda w: {{'raw': w, 'bare': lower(trim(w, '{marks}'))}}), lambda p: p.bare <> '')"
    )


def _template_sql(tokens: str, names: bool = True) -> str:
    units = ", ".join(f"'{u}'" for u in UNITS)
    named = (
        f"WHEN i > 1 AND lower(t.raw) <> t.raw AND regexp_matches(t.raw, '^[^\\p{{L}}\\p{{N}}]*\\p{{Lu}}\\p{{Ll}}+') AND NOT regexp_matches({tokens}[i - 1].raw, '[.!?:][^\\p{{L}}\\p{{N}}]*$') THEN '<name>' "
        if names
        else ""
    )
    return f"list_transform({tokens}, lambda t, i: CASE WHEN t.bare[1] BETWEEN '0' AND '9' THEN '<num>' WHEN t.bare IN ({units}) THEN '<unit>' {named}ELSE t.bare END)"


OP10_SQL = f"""
WITH it AS (SELECT CAST(item_id AS BIGINT) AS item_id, {_words_sql("text")} AS tk FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
items AS (SELECT item_id, tk, {_template_sql("tk")} AS tp, {_template_sql("tk", False)} AS tn, len(tk) AS n FROM it WHERE len(tk) > 0),
variants AS (SELECT item_id, tp AS w, n FROM items UNION ALL SELECT item_id, tn, n FROM items),
targets AS (
  SELECT DISTINCT array_to_string(w[k + 1:k + least(n, {WINDOW})], ' ') AS wk, least(n, {WINDOW}) AS size, item_id, k AS item_at, n AS item_words
  FROM variants, unnest(range(0, n - least(n, {WINDOW}) + 1)) AS u(k)
  WHERE len(list_filter(w[k + 1:k + least(n, {WINDOW})], lambda x: NOT starts_with(x, '<'))) >= least(2, least(n, {WINDOW}))),
d0 AS (SELECT row_number() OVER () AS rid, doc_id, {_words_sql("coalesce(text, '')")} AS tk FROM documents),
d AS (SELECT rid, doc_id, tk, {_template_sql("tk")} AS tp, len(tk) AS n FROM d0),
dw AS (SELECT rid, n AS doc_words, s.size, k AS pos, array_to_string(tp[k + 1:k + s.size], ' ') AS wk FROM d, (SELECT DISTINCT size FROM targets) s, unnest(range(0, greatest(n - s.size + 1, 0))) AS u(k)),
met AS (SELECT rid, item_id, pos - item_at AS shift, item_at, dw.size, item_words FROM dw JOIN targets USING (wk, size) WHERE item_words >= 5 OR doc_words = item_words),
spots AS (SELECT DISTINCT rid, item_id, shift, item_words, p FROM met, unnest(range(item_at, item_at + size)) AS u(p)),
pairs AS (SELECT DISTINCT rid, item_id, shift, i.tk[p + 1].bare AS b, d.tk[p + shift + 1].bare AS v FROM spots JOIN items i USING (item_id) JOIN d USING (rid) WHERE starts_with(i.tp[p + 1], '<')),
clash AS (SELECT rid, item_id, shift FROM pairs GROUP BY ALL HAVING count(*) <> count(DISTINCT b)),
literal AS (
  SELECT m.* FROM met m SEMI JOIN clash USING (rid, item_id, shift) JOIN items i USING (item_id) JOIN d USING (rid)
  WHERE list_transform(i.tk[item_at + 1:item_at + m.size], lambda x: x.bare) = list_transform(d.tk[item_at + shift + 1:item_at + shift + m.size], lambda x: x.bare)),
good AS (
  SELECT rid, item_id, item_words, p FROM spots ANTI JOIN clash USING (rid, item_id, shift)
  UNION SELECT rid, item_id, item_words, p FROM literal, unnest(range(item_at, item_at + literal.size)) AS u(p)),
total AS (SELECT rid, item_id, max(item_words) AS n, count(DISTINCT p) AS covered FROM good GROUP BY 1, 2),
leaks AS (SELECT rid, item_id, round(covered / n, 6) AS coverage FROM total WHERE covered >= {MIN_WORDS} OR round(covered / n, 6) >= {MIN_SHARE}),
per AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS item_ids, max(coverage) AS coverage FROM leaks GROUP BY 1)
SELECT doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, coalesce(item_ids, '') AS item_ids, coalesce(coverage, 0.0) AS coverage FROM d0 LEFT JOIN per USING (rid)
"""
