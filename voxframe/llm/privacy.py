"""Personal data: fixed patterns, and terms that disclose the protected values, in DataFrame functions only.

Values that the patterns find are the protected entities. A term in the same documents discloses an entity as far as the
corpus ties them together: with ``IC(e) = log2(N / df(e))`` and ``PMI(t, e) = log2(N * co(t, e) / (df(t) * df(e)))``,
counted in whole documents, the share ``PMI / IC`` of the entity's information that the term gives away is 1 where the term
appears with the entity alone. Terms that reach ``DISCLOSURE`` in at least ``SUPPORT`` different contexts are generalised
wherever they stand, in documents without the entity too. The words near the entity and those near the term are the
context; near copies of one passage are one, so a text that is merely repeated gives nothing away by that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxframe.session import materialize, may_be_listed, passing

#: The patterns, anchored so that a run of characters is tried from its start only, and possessive so that nothing is
#: tried again; both leave the matches as they are.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_MARKS = {"email": "@", "ip": ".", "phone": "+"}  # a text without it has no match
KINDS = [*PATTERNS, "term"]
#: Code points to either side of an entity, and terms to either side of a term, that tell contexts apart.
REACH = 80
NEAR = 6
TERM = r"[\p{L}\p{N}]+"
DISCLOSURE = 0.8
SUPPORT = 3
_BITS = 65_536
#: Bits of the filter that is held against every word of every text, in numbers of 64; 32 kB whatever the data.
_WORDS = 4096
#: What a text with any match holds: it keeps most others out of what is shuffled.
_MAY_HOLD = r"@|\+[0-9]|[0-9]\.[0-9]|[0-9](?:[\x20-]?[0-9]){13}"


def _pieces(text: Column, pattern: str) -> Column:
    """Matches of a pattern with the text before each and after the last of them: ``(before, found, after)``."""
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    both = F.struct(matches.alias("m"), gaps.alias("g"))
    made = F.transform(F.array(both), lambda x: F.transform(x["m"], lambda m, i: F.struct(F.get(x["g"], i).alias("before"), m.alias("found"), F.get(x["g"], i + 1).alias("after"))))
    return F.element_at(made, 1)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    numbers = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c: c.cast("int"))
    doubled = F.transform(numbers, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: Column, found: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.when(F.length(bare) <= 3, bare.cast("int") <= 255).otherwise(False)

    digits = _digits(found)
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", F.forall(F.split(found, r"\."), small))
        .when(kind == "card", F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False))
        .otherwise(F.length(digits).between(10, 15))
    )


def _context(before: Column, after: Column) -> Column:
    """Least hash of the terms around an entity, so near copies of one passage agree."""
    terms = F.regexp_extract_all(F.concat(before, F.lit(" "), after), F.lit(TERM), F.lit(0))
    return F.array_min(F.transform(terms, lambda t: F.xxhash64(F.lower(t))))


def _described(kind: str) -> Callable[[Column, Column], Column]:
    """A match with its kind, number, the length of the text before it and the near part of the text around it."""

    def describe(p: Column, i: Column) -> Column:
        before, after = p["before"], p["after"]
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.length(before).alias("gap"),
            p["found"].alias("found"),
            F.when(F.length(before) > REACH, F.regexp_replace(F.right(before, F.lit(REACH)), r"^[\p{L}\p{N}]+", "")).otherwise(before).alias("before"),
            F.when(F.length(after) > REACH, F.regexp_replace(F.left(after, F.lit(REACH)), r"[\p{L}\p{N}]+$", "")).otherwise(after).alias("after"),
        )

    return describe


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def _entities(texts: DataFrame) -> DataFrame:
    """Every valid match: ``key, mark, kind, start, end, entity, found`` and the text near it, ``before`` and ``after``."""
    lists = []
    for kind, pattern in PATTERNS.items():
        has = F.contains("text", F.lit(_MARKS[kind])) if kind in _MARKS else F.lit(True)
        lists.append(F.when(has, F.transform(_pieces(F.col("text"), pattern), _described(kind))))
    none = F.array().cast("array<struct<kind:string,i:int,gap:int,found:string,before:string,after:string>>")
    rows = texts.select("key", "mark", F.explode(F.concat(*[F.coalesce(x, none) for x in lists])).alias("p")).select("key", "mark", "p.*")
    so_far = Window.partitionBy("key", "mark", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    # Rows that repeat key and text are the same document.
    rows = rows.dropDuplicates(["key", "mark", "kind", "i"]).withColumn("end", F.sum(F.col("gap") + F.length("found")).over(so_far))
    rows = rows.withColumn("start", F.col("end") - F.length("found")).where(_valid(F.col("kind"), F.col("found")))
    return rows.select("key", "mark", "kind", "start", "end", F.concat("kind", F.lit(":"), F.lower("found")).alias("entity"), "found", "before", "after")


def _shared() -> Column:
    """Share of an entity's information that a term gives away, from ``n_docs``, ``df_e``, ``df_t`` and ``co``; null for none."""
    information = F.log2(F.col("n_docs") / F.col("df_e"))
    shared = F.log2(F.col("n_docs") * F.col("co") / (F.greatest("df_t", "co") * F.col("df_e")))
    return F.when(information > 0, shared / information)


def _same(k: str = "k", m: str = "m") -> Column:
    """One document: the same key, null too, and the same mark."""
    return F.col("key").eqNullSafe(F.col(k)) & (F.col("mark") == F.col(m))


def _masked(docs: DataFrame, texts: DataFrame, entities: DataFrame, once: bool = True) -> DataFrame:
    """The columns of ``docs`` (``key, mark`` of documents, each once) their ``text``, and ``masked``, with blanks for entities.

    Repeated rows are one, unless ``once`` is false: then no text is shuffled to find them.
    """
    spans = entities.groupBy("key", "mark").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans")).withColumnsRenamed({"key": "k", "mark": "m"})
    # Written first: where the list is small, which its size on disk tells the planner, no text is shuffled for it.
    listed = materialize(docs.join(spans, _same(), "left").select(docs.columns + ["spans"]), "privacy-listed").withColumnsRenamed({"key": "k", "mark": "m"})
    rows = texts.join(listed, _same()).drop("k", "m")
    rows = rows.dropDuplicates(["key", "mark"]) if once else rows
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("end"))

    def blank(state: Column, span: Column) -> Column:
        low, high = F.greatest(state["end"], span["start"].cast("long")), F.greatest(state["end"], span["end"].cast("long"))
        plain = F.substring(F.col("text"), (state["end"] + 1).cast("int"), (low - state["end"]).cast("int"))
        return F.struct(F.concat(state["done"], plain, F.repeat(F.lit(" "), (high - low).cast("int"))).alias("done"), high.alias("end"))

    rest = lambda s: F.concat(s["done"], F.substring(F.col("text"), (s["end"] + 1).cast("int"), F.length("text")))
    masked = F.when(F.size("spans") > 0, F.aggregate("spans", start, blank, rest)).otherwise(F.col("text"))
    return rows.select(*docs.columns, "text", masked.alias("masked"))


def _hashes(text: str) -> Column:
    """Hashes of all terms of a text; a term is its hash from here on."""
    return F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda t: F.xxhash64(F.lower(t)))


def _terms(masked: DataFrame) -> DataFrame:
    """Every term of every document once, found inside the row: the columns but the text, ``term`` and its ``context``."""

    def with_context(all_terms: Column) -> Column:
        # The term itself is no part of its context.
        near = [*range(-NEAR, 0), *range(1, NEAR + 1)]
        return F.transform(all_terms, lambda h, i: F.struct(h.alias("term"), F.least(*[F.get(all_terms, i + d) for d in near]).alias("context")))

    def first_of_each(found: Column) -> Column:
        return F.filter(found, lambda x, i: (i == 0) | (F.get(found, i - 1)["term"] != x["term"]))

    ordered = F.transform(F.array(_hashes("masked")), lambda a: F.sort_array(with_context(a)))
    found = F.element_at(F.transform(ordered, first_of_each), 1)
    return masked.select(*[c for c in masked.columns if c != "masked"], F.explode(found).alias("t")).select("*", "t.*").drop("t")


def _placed(rows: DataFrame, text: str) -> DataFrame:
    """Every occurrence of a document's ``terms`` in a column, found inside the row: ``key, mark, term, start, end``."""
    pieces = F.transform(
        _pieces(F.col(text), TERM),
        lambda p: F.struct(F.length(p["before"]).alias("gap"), F.length(p["found"]).alias("size"), F.xxhash64(F.lower(p["found"])).alias("term")),
    )
    nothing = F.struct(F.lit(0).cast("long").alias("end"), F.array().cast("array<struct<term:bigint,start:bigint,end:bigint>>").alias("found"))

    def step(state: Column, p: Column) -> Column:
        start, end = state["end"] + p["gap"], state["end"] + p["gap"] + p["size"]
        more = F.concat(state["found"], F.array(F.struct(p["term"].alias("term"), start.alias("start"), end.alias("end"))))
        return F.struct(end.alias("end"), F.when(F.array_contains(F.col("terms"), p["term"]), more).otherwise(state["found"]).alias("found"))

    places = F.explode(F.aggregate(pieces, nothing, step, lambda s: s["found"]))
    return rows.select("key", "mark", places.alias("p")).select("key", "mark", "p.*").distinct()


def _bitmap(terms: DataFrame) -> DataFrame:
    """One row ``bits``: a filter of fixed size that every one of the ``terms`` passes and most other words do not."""
    bit = F.pmod("term", F.lit(64 * _WORDS))
    set_bits = terms.select(F.floor(bit / 64).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(term, {64 * _WORDS}) % 64 as int))").alias("bits"))
    every = terms.sparkSession.range(_WORDS).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = set_bits.union(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return words.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("bits"))


def _everywhere(texts: DataFrame, flagged: DataFrame, entities: DataFrame) -> DataFrame:
    """Every occurrence of the flagged terms outside entities: ``key, mark, start, end``.

    A text is looked through where it lies; only the places found move. Documents with entities, whose words end where an
    entity begins, are placed again in their masked texts.
    """

    def may_be(term: Column) -> Column:
        bit = F.pmod(term, F.lit(64 * _WORDS))
        return F.getbit(F.get("bits", F.floor(bit / 64).cast("int")), (bit % 64).cast("int")) == 1

    likely = F.filter(F.array_distinct(_hashes("text")), may_be)
    hits = texts.join(F.broadcast(_bitmap(flagged))).select("key", "mark", "text", likely.alias("terms")).where(F.size("terms") > 0)
    found = materialize(_placed(hits, "text").join(flagged, "term", "left_semi"), "privacy-places")
    own = materialize(entities.select(F.col("key").alias("k"), F.col("mark").alias("m")).distinct(), "privacy-own")
    again = found.join(own, _same(), "left_semi").groupBy("key", "mark").agg(F.collect_set("term").alias("terms"))
    masked = _masked(again, texts.where(F.col("text").rlike(_MAY_HOLD)), entities, once=False)
    places = found.join(own, _same(), "left_anti").unionByName(_placed(masked, "masked"))
    return places.select("key", "mark", "start", "end").distinct()


def _counted(texts: DataFrame, known: DataFrame) -> DataFrame:
    """``term, df_all``: documents whose whole text has the term, for all ``known`` terms; counted before anything moves."""
    # A bitmap of fixed size keeps most other words out.
    bits = known.select(F.pmod("term", F.lit(_BITS)).alias("bit")).distinct()
    words = texts.select(F.explode(F.array_distinct(_hashes("text"))).alias("term")).withColumn("bit", F.pmod("term", F.lit(_BITS)))
    rows = words.join(F.broadcast(bits), "bit", "left_semi").groupBy("term").agg(F.count("*").alias("n"))
    # Rows that repeat key and text are the same document.
    repeated = materialize(texts.groupBy("key", "mark").agg(F.count("*").alias("rows")).where("rows > 1"), "privacy-repeated")
    once = texts.join(repeated.withColumnsRenamed({"key": "k", "mark": "m"}), _same()).select("key", "mark", "text", "rows").dropDuplicates(["key", "mark"])
    more = once.select(F.explode(F.array_distinct(_hashes("text"))).alias("term"), (1 - F.col("rows")).alias("n"))
    both = rows.unionByName(more.groupBy("term").agg(F.sum("n").alias("n"))).join(known.select("term"), "term", "left_semi")
    return both.groupBy("term").agg(F.sum("n").alias("df_all"))


def _disclosing(texts: DataFrame, entities: DataFrame) -> DataFrame:
    """All spans of terms that disclose an entity, in whatever document: ``key, mark, start, end``."""
    size = texts.select("key", "mark").distinct().agg(F.count("*").cast("double").alias("n_docs"))
    with_any = texts.where(F.col("text").rlike(_MAY_HOLD))
    # Documents of one text are one context: the first stands for all of them, with their number.
    alike = entities.select("key", "mark").distinct().groupBy("mark").agg(F.min("key").alias("key"), F.count("*").alias("copies"))
    alike = materialize(alike, "privacy-documents")
    own = entities.join(alike.withColumnsRenamed({"key": "k", "mark": "m"}), _same())
    own = own.withColumn("context", _context(F.col("before"), F.col("after"))).groupBy("mark", "entity", "copies").agg(F.min("context").alias("beside"))
    asked = own.groupBy("entity").agg(F.sum("copies").alias("df_e"), F.count("*").alias("texts")).where(F.col("texts") >= SUPPORT).drop("texts")
    asked = materialize(own.drop("copies").join(asked, "entity"), "privacy-asked")
    held = alike.join(asked.select("mark").distinct(), "mark", "left_semi").select("key", "mark", "copies")
    terms = materialize(_terms(_masked(held, with_any, entities)).drop("key", "text"), "privacy-terms")
    seen = terms.groupBy("term").agg(F.sum("copies").alias("df_held"), F.count("*").alias("texts")).where(F.col("texts") >= SUPPORT).drop("texts")
    # A term is in no fewer documents than in these: that bound rules out the common words before they meet an entity.
    most = asked.agg(F.max("df_e").cast("double").alias("most")).join(size)  # one row
    usual = F.pow("most", F.lit(DISCLOSURE)) * F.pow("n_docs", F.lit(1 - DISCLOSURE)) + 1
    seen = materialize(seen.join(F.broadcast(most), F.col("df_held") <= usual), "privacy-seen")
    # The same bound with the document frequencies; documents with the term inside an entity may or may not be among them.
    inside = entities.select("key", "mark", F.explode(F.array_distinct(_hashes("found"))).alias("term")).distinct()
    inside = materialize(inside.join(seen.select("term"), "term", "left_semi"), "privacy-inside")
    known = seen.join(_counted(texts, seen), "term", "left").join(inside.groupBy("term").agg(F.count("*").alias("hidden")), "term", "left")
    known = known.na.fill(0, ["df_all", "hidden"]).withColumn("df_t", F.greatest(F.col("df_all") - F.col("hidden"), "df_held"))
    known = materialize(known.where(F.col("df_t") <= usual).select("term", "df_t", "df_all", "hidden", "n_docs"), "privacy-known")
    pairs = terms.join(known, "term").join(asked, "mark").withColumn("co", F.least("df_t", "df_e")).where(_shared() >= DISCLOSURE)
    given = ("df_e", "df_t", "df_all", "hidden", "n_docs")
    places = pairs.groupBy("entity", "term", "beside", "context").agg(F.sum("copies").alias("co"), *[F.first(c).alias(c) for c in given])
    tied = places.groupBy("entity", "term").agg(F.count("*").alias("contexts"), F.sum("co").alias("co"), *[F.first(c).alias(c) for c in given])
    tied = materialize(tied.where((F.col("contexts") >= SUPPORT) & (_shared() >= DISCLOSURE)).drop("df_t"), "privacy-pairs")
    # Where those documents decide, each is looked into: the term inside its entities alone makes it none of the term's.
    worst = tied.withColumn("df_t", F.col("df_all") + F.col("hidden"))
    open_terms = worst.where((F.col("hidden") > 0) & (_shared() < DISCLOSURE)).select("term").distinct()
    open_inside = materialize(inside.join(open_terms, "term", "left_semi"), "privacy-open")
    texts_of = _masked(open_inside.select("key", "mark").distinct(), with_any, entities)
    asked_of = open_inside.select(F.col("key").alias("k"), F.col("mark").alias("m"), F.col("term").alias("t"))
    changes = []
    for column, change in (("text", -1), ("masked", 1)):
        found = texts_of.select("key", "mark", F.explode(F.array_distinct(_hashes(column))).alias("term"))
        changes.append(found.join(asked_of, _same() & (F.col("term") == F.col("t")), "left_semi").select("term", F.lit(change).alias("change")))
    changed = changes[0].union(changes[1]).groupBy("term").agg(F.sum("change").alias("change"))
    exact = tied.join(changed, "term", "left").withColumn("df_t", F.col("df_all") + F.coalesce("change", F.lit(0)))
    flagged = materialize(exact.where(_shared() >= DISCLOSURE).select("term").distinct(), "privacy-flagged")
    return _everywhere(texts, flagged, entities)


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, mark, spans`` of every document with any: ``(start, order, end, kind)`` in order, code points.

    ``mark`` is xxhash64 of the text; rows that repeat key and text share one row here. A term span that touches a
    pattern's span is left out, one inside a longer kept list stays. A null text has none; other columns are not read.
    """
    # a null key or text is kept apart by its mark
    texts = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("mark"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    entities = materialize(_entities(texts), "privacy-entities")
    base = entities.select("key", "mark", "kind", "start", "end")
    terms = _disclosing(texts, entities).select("key", "mark", F.lit("term").alias("kind"), "start", "end")
    order = F.array_position(F.lit(KINDS), F.col("kind")).cast("int")
    span = F.struct(F.col("start").cast("long").alias("start"), order.alias("order"), F.col("end").cast("long").alias("end"), F.col("kind").alias("kind"))
    found = base.union(terms).groupBy("key", "mark").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    kept = F.filter("spans", lambda s: s["kind"] != "term")
    clear = F.filter("spans", lambda s: (s["kind"] != "term") | ~F.exists("kept", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return found.withColumn("kept", kept).select("key", "mark", clear.alias("spans"))


def _written(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def personal_data_digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, digest of the pattern spans and the list of all spans, for every document."""
    found = personal_data(docs, key, text).withColumnsRenamed({"key": "k", "mark": "m"})
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("mark"))
    none = F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string>>")
    rows = rows.join(found, F.col("key").eqNullSafe(F.col("k")) & (F.col("mark") == F.col("m")), "left").withColumn("spans", F.coalesce("spans", none))
    counts = [F.size(F.filter("spans", _of_kind(kind))).cast("long").alias(f"n_{kind}") for kind in PATTERNS]
    base = F.filter("spans", lambda s: s["kind"] != "term")
    return rows.select(F.col("key").alias(key), *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def sanitised(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every span of personal data generalised to its kind, such as ``[EMAIL]``; overlapping spans are one.

    All columns and rows are kept, in their order of columns; a null text stays null.
    """
    with passing(docs.sparkSession):
        found = materialize(personal_data(docs, key, text), "privacy-spans", keep=True).withColumnsRenamed({"key": "_k", "mark": "_m", "spans": "_spans"})
    # Only texts that may have a span meet the list; the others stay where they are.
    told = may_be_listed(docs, F.xxhash64(F.col(text)), found, "_m")
    joined = told.where("_listed").join(found, F.col(key).eqNullSafe(F.col("_k")) & (F.xxhash64(F.col(text)) == F.col("_m")), "left")
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("end"))

    def replace(state: Column, span: Column) -> Column:
        plain = F.substring(F.col(text), (state["end"] + 1).cast("int"), (span["start"] - state["end"]).cast("int"))
        inside = span["start"] < state["end"]
        done = F.when(inside, state["done"]).otherwise(F.concat(state["done"], plain, F.lit("["), F.upper(span["kind"]), F.lit("]")))
        return F.struct(done.alias("done"), F.greatest(state["end"], span["end"]).alias("end"))

    rest = lambda s: F.concat(s["done"], F.substring(F.col(text), (s["end"] + 1).cast("int"), F.length(text)))
    clean = F.when(F.size("_spans") > 0, F.aggregate("_spans", start, replace, rest)).otherwise(F.col(text))
    return joined.withColumn(text, clean).select(docs.columns).union(told.where(~F.col("_listed")).select(docs.columns))
