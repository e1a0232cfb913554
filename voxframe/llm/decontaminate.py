"""Benchmark decontamination by winnowing, in DataFrame functions only.

Items and documents keep the smallest hash of ``GRAM`` consecutive words in every window of words. Equal windows have
equal smallest hashes, so a document and an item that share a window share a kept hash. Kept hashes are joined, and at
every place of a shared hash the match is extended word by word in both directions, as far as a window can reach.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxframe.session import materialize

WINDOW = 10
GRAM = 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _mixed_case_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), _BETWEEN), lambda w: w != "")


def item_words(text: Column) -> Column:
    """Runs of ASCII digits, lower-case letters and all other letters, after A-Z are lower-cased; none for null."""
    # only words that have something to lower are mapped letter by letter
    return F.transform(
        _mixed_case_words(text), lambda w: F.when(F.lower(w) == w, w).otherwise(F.translate(w, string.ascii_uppercase, string.ascii_lowercase))
    )


def _grams(words: Column, length: int) -> Column:
    """Hash of ``length`` consecutive words from every start; empty where there are too few.

    Hashes of shorter runs are joined pairwise.
    """

    def grown(known: dict[int, Column], have: int) -> Column:
        if have == length:
            return known[have]
        more = max(n for n in known if n <= length - have)
        joined = F.zip_with(known[have], F.slice(known[more], have + 1, F.size(words)), lambda x, y: F.xxhash64(x, y))
        return _once(joined, lambda c: grown({**known, have + more: c}, have + more))

    grams = _once(F.transform(words, lambda w: F.xxhash64(w)), lambda h: grown({1: h}, 1))
    return F.when(F.size(words) >= length, F.slice(grams, F.lit(1), F.size(words) - length + 1)).otherwise(F.array().cast("array<bigint>"))


def _once(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use``."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _kept(words: Column, window: int) -> Column:
    """Smallest gram hash of every window of ``window`` words, distinct."""
    gram = min(GRAM, window)
    width = window - gram + 1

    def smallest(g: Column) -> Column:
        if width == 1:
            return g
        at = F.sequence(F.lit(0), F.size(g) - width)
        return F.transform(at, lambda i: F.least(*[F.get(g, i + k) for k in range(width)]))

    found = _once(_once(words, lambda w: _grams(w, gram)), lambda g: F.when(F.size(g) >= width, smallest(g)).otherwise(F.array().cast("array<bigint>")))
    return F.array_distinct(found)


def _run(matches: Column) -> Column:
    """How many leading values are true."""
    stop = F.array_position(matches, False)
    return F.when(stop > 0, stop - 1).otherwise(F.size(matches))


def _places(rows: DataFrame, window: int, *carried: str) -> DataFrame:
    """Every place of a kept hash in ``words``: its hash, start, and the words a window could reach around it.

    ``hashes`` names the kept hashes of interest.
    """
    gram = min(GRAM, window)
    reach = window - gram
    listed = F.transform(_once(F.col("words"), lambda w: _grams(w, gram)), lambda g, i: F.struct(g.alias("kept"), i.cast("int").alias("at")))
    places = F.filter(listed, lambda p: F.array_contains(F.col("hashes"), p["kept"]))
    out = rows.select(*carried, "words", F.explode(places).alias("p")).select(*carried, "words", "p.kept", "p.at")
    before = F.reverse(F.slice("words", F.greatest(F.col("at") - reach, F.lit(0)) + 1, F.least(F.col("at"), F.lit(reach))))
    after = F.slice("words", F.col("at") + gram + 1, F.lit(reach))
    return out.select(*carried, "kept", "at", F.slice("words", F.col("at") + 1, F.lit(gram)).alias("gram"), before.alias("before"), after.alias("after"))


def _covered(spans: Column) -> Column:
    """Number of positions that a list of ``(start, end)`` covers."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(state: Column, span: Column) -> Column:
        low = F.greatest(state["end"], span["start"].cast("long"))
        high = F.greatest(state["end"], span["end"].cast("long"))
        return F.struct((state["n"] + high - low).alias("n"), high.alias("end"))

    return F.aggregate(F.array_sort(spans), start, add, lambda state: state["n"])


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = WINDOW
) -> DataFrame:
    """``key, n_words, n_hit, n_items, items_sha256, contaminated`` of every document.

    A window is ``window`` consecutive words of an item, or all of an item that has fewer; a document word inside an
    occurrence of a window is hit. Null or wordless texts have no words and no windows. An item without an id hits words
    but is not listed. Rows that repeat key and text get the same result each; other columns are not read. Neither side
    is assumed small: the planner may broadcast the kept hashes of the items if it finds them so.
    """
    mark = [F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("mark")]
    texts = docs.select(*mark, F.col(text).cast("string").alias("text"))
    listed = items.select(F.col(item_key).cast("string").alias("item"), item_words(F.col(item_text)).alias("words")).where("size(words) > 0")
    listed = materialize(listed.withColumn("window", F.least(F.size("words"), F.lit(window))), "items")
    lengths = sorted(row[0] for row in listed.select("window").distinct().collect())  # at most ``window`` numbers
    spans = None
    for length in lengths:
        gram = min(GRAM, length)
        own = listed.where(F.col("window") == length).withColumn("hashes", _kept(F.col("words"), length))
        wanted = own.select(F.explode("hashes").alias("kept")).distinct()
        kept = texts.select("key", "mark", F.explode(_kept(item_words(F.col("text")), length)).alias("kept"))
        shared = kept.join(wanted, "kept").groupBy("key", "mark").agg(F.collect_set("kept").alias("hashes"))
        shared = shared.withColumnsRenamed({"key": "k", "mark": "m"})
        again = texts.join(shared, F.col("key").eqNullSafe(F.col("k")) & F.col("mark").eqNullSafe(F.col("m")))
        again = again.select("key", "mark", item_words(F.col("text")).alias("words"), "hashes")
        left = _places(again, length, "key", "mark")
        right = _places(own, length, "item").withColumnsRenamed({"gram": "i_gram", "before": "i_before", "after": "i_after"}).drop("at").distinct()
        back = _run(F.zip_with("before", "i_before", lambda x, y: F.coalesce(x == y, F.lit(False))))
        on = _run(F.zip_with("after", "i_after", lambda x, y: F.coalesce(x == y, F.lit(False))))
        met = left.join(right, "kept").where(F.col("gram") == F.col("i_gram")).withColumn("back", back).withColumn("on", on)
        met = met.where(F.col("back") + gram + F.col("on") >= length)
        hit = met.select("key", "mark", "item", F.struct((F.col("at") - F.col("back")).cast("int").alias("start"), (F.col("at") + gram + F.col("on")).cast("int").alias("end")).alias("span"))
        spans = hit if spans is None else spans.union(hit)
    counted = texts.select("key", "mark", F.size(_mixed_case_words(F.col("text"))).cast("long").alias("n_words"))
    if spans is None:
        found = counted.withColumns({"n_hit": F.lit(0).cast("long"), "items": F.array().cast("array<string>")})
    else:
        by_text = spans.groupBy("key", "mark").agg(_covered(F.collect_set("span")).alias("n_hit"), F.array_sort(F.collect_set("item")).alias("items"))
        by_text = by_text.withColumnsRenamed({"key": "k", "mark": "m"})
        found = counted.join(by_text, F.col("key").eqNullSafe(F.col("k")) & F.col("mark").eqNullSafe(F.col("m")), "left")
    hits, ids = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return found.select(
        F.col("key").alias(key),
        "n_words",
        hits.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


#: The same for ``documents`` and ``benchmark`` by comparing all windows.
CONTAMINATION_SQL = rf"""WITH i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}') AS w FROM benchmark),
sized AS (SELECT item_id, w, least({WINDOW}, len(w)) AS l FROM i WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, l, array_to_string(w[s:s + l - 1], ' ') AS k
  FROM (SELECT *, unnest(generate_series(1, len(w) - l + 1)) AS s FROM sized)),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}') AS w FROM documents),
starts AS (
  SELECT doc_id, l, unnest(generate_series(1, len(w) - l + 1)) AS s, w FROM d, (SELECT DISTINCT l FROM win)),
hit AS (
  SELECT o.doc_id, o.s, o.l, win.item_id
  FROM (SELECT doc_id, s, l, array_to_string(w[s:s + l - 1], ' ') AS k FROM starts) o JOIN win USING (l, k)),
spots AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(generate_series(s, s + l - 1)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(k, ',' ORDER BY k) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(spots.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(spots.n, 0) > 0 AS contaminated
FROM d LEFT JOIN spots USING (doc_id) LEFT JOIN items USING (doc_id)"""
