"""Array, vector and JSON queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxframe.catalog.aggregating import rounded_vector
from voxframe.catalog.base import WORDS_SQL, query, table, texts
from voxframe.functions.arrays import (
    align_two_rates,
    contains_run,
    crop_or_pad,
    cross_fade,
    default_vectors,
    doubling_chunks,
    equal_chunks,
    finite_json,
    interleave_applies,
    interleaved_target,
    l2_normalize,
    limit_peak,
    linear_resize,
    pad_mask,
    pad_to_multiple,
    plain_target,
    to_mono,
    valid_tokens,
)
from voxframe.functions.hashing import hash_fraction, hash_index, stable_key
from voxframe.functions.injected import whitespace_tokens
from voxframe.operators.ordering import with_ordinal
from voxframe.operators.packing import static_batches
from voxframe.operators.sequences import reassembled
from voxframe.plans.batches import padded_batches

TOKENS_SQL = f"list_transform({WORDS_SQL}, lambda w: length(w)::INTEGER)"


def _shown(values: str) -> str:
    return f"array_to_string(list_transform({values}, lambda v: printf('%.5f', v + 0.0)), ' ')"


def _joined(values):
    return F.array_join(F.transform(values, lambda v: v.cast("string")), ",")


_E = "list_transform(embedding, lambda v: v::DOUBLE)"


@query(
    "unit_vectors",
    "ARR-01",
    sql=f"SELECT vec_id, {_shown('list_transform(e, lambda v: v / greatest(sqrt(list_dot_product(e, e)), 1e-12))')} AS unit FROM (SELECT vec_id, {_E} AS e FROM embeddings)",
)
def unit_vectors(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", l2_normalize(F.col("embedding")).alias("unit"))
    return vectors.select("vec_id", rounded_vector("unit").alias("unit"))


@query(
    "defaulted_vectors",
    "ARR-02",
    sql=f"""SELECT vec_id, CASE WHEN label < 3 THEN {_shown('e')} WHEN label > 6 THEN {_shown('e[1:2]')} END AS utt, CASE WHEN label BETWEEN 3 AND 6 THEN {_shown('e')} WHEN label > 6 THEN {_shown('e[1:2]')} END AS spk
FROM (SELECT vec_id, label, {_E} AS e FROM embeddings)""",
)
def defaulted_vectors(spark, folder):
    """Labels below 3 have an utterance vector, 3 to 6 a speaker vector, the others get one computed for both."""
    label = F.col("label")
    own, speaker = F.when(label < 3, F.col("embedding")), F.when(label.between(3, 6), F.col("embedding"))
    utt, spk = default_vectors(own, speaker, F.slice("embedding", 1, 2))
    rows = table(spark, folder, "embeddings").select("vec_id", utt.alias("utt"), spk.alias("spk"))
    return rows.select("vec_id", rounded_vector("utt").alias("utt"), rounded_vector("spk").alias("spk"))


@query(
    "padded_token_batches",
    "ARR-03",
    "TOP-08",
    sql=f"""WITH t AS (SELECT conv_id * 100 + turn AS id, {TOKENS_SQL} AS t, row_number() OVER (ORDER BY conv_id * 100 + turn) - 1 AS i FROM conversations),
m AS (SELECT i // 8 AS batch, max(len(t)) AS n FROM t GROUP BY 1)
SELECT m.batch, string_agg(id::VARCHAR, ',' ORDER BY len(t) DESC, i) AS ids, string_agg(len(t)::VARCHAR, ',' ORDER BY len(t) DESC, i) AS lengths,
md5(string_agg(array_to_string(t || list_transform(range(0, n - len(t)), lambda k: 0), ','), ';' ORDER BY len(t) DESC, i)) AS padded_md5, NULL::VARCHAR AS optional
FROM t JOIN m ON m.batch = i // 8 GROUP BY 1""",
)
def padded_token_batches(spark, folder):
    """Eight turns per batch, longest first; the optional field is missing in odd turns, so no batch has it."""
    turns = texts(spark, folder, "conversations", "conv_id").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"), "turn", whitespace_tokens(F.col("text")).alias("t")
    )
    rows = turns.withColumns({"n": F.size("t"), "o": F.when(F.col("turn") % 2 == 0, F.col("t"))})
    batched = static_batches(with_ordinal(rows, "id"), "ordinal", ["id", "n", "t", "o"], 8)
    out = padded_batches(batched, "rows", "n", ["t", "o"], ["id"])
    matrix = F.array_join(F.transform("t", _joined), ";")
    return out.select(
        "batch", _joined("id").alias("ids"), _joined("t_len").alias("lengths"), F.md5(matrix).alias("padded_md5"), _joined("o_len").alias("optional")
    )


@query(
    "pad_masks",
    "ARR-04",
    sql="""SELECT l_orderkey, string_agg(m, ';' ORDER BY n, q, p) AS masks FROM (
SELECT l_orderkey, l_linenumber AS n, l_quantity::INTEGER AS q, l_partkey AS p, repeat('0', l_quantity::INTEGER) || repeat('1', (max(l_quantity) OVER (PARTITION BY l_orderkey) - l_quantity)::INTEGER) AS m FROM lineitem) GROUP BY 1""",
)
def pad_masks(spark, folder):
    rows = F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col("l_quantity").cast("int").alias("q"), F.col("l_partkey").alias("p"))))
    grouped = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(rows.alias("rows"), F.max(F.col("l_quantity").cast("int")).alias("longest"))
    bits = lambda r: F.array_join(F.transform(pad_mask(r["q"], F.col("longest")), lambda b: b.cast("int").cast("string")), "")
    return grouped.select("l_orderkey", F.array_join(F.transform("rows", bits), ";").alias("masks"))


@query(
    "fixed_length_windows",
    "ARR-05",
    sql=f"""WITH t AS (SELECT doc_id, {TOKENS_SQL} AS t FROM documents), s AS (SELECT doc_id, t, CASE WHEN len(t) > 128 THEN ('0x' || sha256('5' || chr(0) || doc_id)[1:15])::BIGINT % (len(t) - 127) ELSE 0 END AS s FROM t)
SELECT doc_id, md5(array_to_string(CASE WHEN len(t) > 128 THEN t[s + 1 : s + 128] ELSE t || list_transform(range(0, 128 - len(t)), lambda k: 0) END, ',')) AS window_md5 FROM s""",
)
def fixed_length_windows(spark, folder):
    docs = texts(spark, folder).select("doc_id", whitespace_tokens(F.col("text")).alias("t"))
    start = hash_index(stable_key(5, "doc_id"), F.greatest(F.size("t") - 127, F.lit(1)))
    return docs.select("doc_id", F.md5(_joined(crop_or_pad(F.col("t"), 128, start, 0))).alias("window_md5"))


@query(
    "multiple_length_arrays",
    "ARR-06",
    sql=f"SELECT conv_id, turn, (ceil(len({WORDS_SQL}) / 12.0) * 12)::INTEGER AS n, list_sum({TOKENS_SQL})::BIGINT AS total FROM conversations",
)
def multiple_length_arrays(spark, folder):
    padded = pad_to_multiple(whitespace_tokens(F.col("text")), 12, 0)
    total = F.aggregate(padded, F.lit(0).cast("bigint"), lambda a, v: a + v)
    return texts(spark, folder, "conversations", "conv_id").select("conv_id", "turn", F.size(padded).alias("n"), total.alias("total"))


@query(
    "aligned_token_rates",
    "ARR-07",
    sql=f"""SELECT conv_id, turn, (2 * k)::INTEGER AS features, k::INTEGER AS tokens, coalesce(list_sum(t[1:k]), 0)::BIGINT AS total FROM (
SELECT conv_id, turn, {TOKENS_SQL} AS t, least(length(text) // 9, len({WORDS_SQL})) AS k FROM conversations)""",
)
def aligned_token_rates(spark, folder):
    """Two features per token, with two features for nine characters."""
    features = F.array_repeat(F.lit(0), F.floor(F.char_length("text") / 9).cast("int") * 2)
    cut, tokens = align_two_rates(features, whitespace_tokens(F.col("text")))
    total = F.aggregate(tokens, F.lit(0).cast("bigint"), lambda a, v: a + v)
    return texts(spark, folder, "conversations", "conv_id").select(
        "conv_id", "turn", F.size(cut).alias("features"), F.size(tokens).alias("tokens"), total.alias("total")
    )


@query(
    "limited_peaks",
    "ARR-08",
    sql=f"""SELECT vec_id, {_shown("list_transform(e, lambda v: CASE WHEN peak > 1 THEN v / peak ELSE v END)")} AS samples
FROM (SELECT vec_id, e, list_max(list_transform(e, lambda v: abs(v))) AS peak FROM (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE * 3) AS e FROM embeddings))""",
)
def limited_peaks(spark, folder):
    loud = F.transform("embedding", lambda v: v.cast("double") * 3)
    rows = table(spark, folder, "embeddings").select("vec_id", limit_peak(loud).alias("samples"))
    return rows.select("vec_id", rounded_vector("samples").alias("samples"))


@query(
    "mono_samples",
    "ARR-09",
    sql=f"""SELECT vec_id, {_shown("list_transform(range(1, 65), lambda i: (e[i] + e[65 - i]) / 2)")} AS samples FROM (SELECT vec_id, {_E} AS e FROM embeddings)""",
)
def mono_samples(spark, folder):
    """Two channels: the vector and the vector reversed."""
    mono = to_mono(F.array(F.col("embedding"), F.reverse("embedding")))
    rows = table(spark, folder, "embeddings").select("vec_id", mono.alias("samples"))
    return rows.select("vec_id", rounded_vector("samples").alias("samples"))


@query(
    "interleaved_targets",
    "ARR-10",
    sql=f"""WITH t AS (SELECT conv_id, turn, len({WORDS_SQL}) AS n, list_transform(range(0, length(text)), lambda i: i::INTEGER) AS s,
('0x' || sha256('9' || chr(0) || conv_id || chr(0) || turn)[1:13])::BIGINT / 4503599627370496.0::DOUBLE AS coin FROM conversations)
SELECT conv_id, turn, coin < 0.5 AND len(s) / n::DOUBLE > 3 AS interleaved, md5(array_to_string(CASE WHEN coin < 0.5 AND len(s) / n::DOUBLE > 3
 THEN [-1] || flatten(list_transform(range(0, n // 5), lambda j: [-1, -1, -1, -1] || s[15 * j + 1 : 15 * j + 15] || [7000])) || list_transform(range(0, n % 5), lambda k: -1) || s[15 * (n // 5) + 1 :] || [7001]
 ELSE list_transform(range(0, n + 1), lambda k: -1) || s || [7001] END, ',')) AS target_md5 FROM t""",
)
def interleaved_targets(spark, folder):
    """Words as text tokens, character positions as speech tokens."""
    turns = texts(spark, folder, "conversations", "conv_id").select("conv_id", "turn", "text", whitespace_tokens(F.col("text")).alias("t"))
    speech = F.when(F.char_length("text") > 0, F.sequence(F.lit(0), F.char_length("text") - 1))
    rows = turns.withColumn("s", speech).withColumn(
        "use", interleave_applies(F.col("t"), F.col("s"), hash_fraction(stable_key(9, "conv_id", "turn")))
    )
    target = F.when(F.col("use"), interleaved_target(F.col("t"), F.col("s"), 7000, 7001)).otherwise(plain_target(F.col("t"), F.col("s"), 7001))
    return rows.select("conv_id", "turn", F.col("use").alias("interleaved"), F.md5(_joined(target)).alias("target_md5"))


@query(
    "equal_size_chunks",
    "ARR-11",
    "UDT-02",
    sql=f"""WITH t AS (SELECT conv_id, turn, {TOKENS_SQL} AS t, greatest((len({WORDS_SQL}) - 3) // 10, 0) AS k FROM conversations)
SELECT conv_id, turn, c::INTEGER AS chunk, array_to_string(CASE WHEN c < k THEN t[10 * c + 1 : 10 * c + 13] ELSE t[10 * c + 1 :] END, ',') AS tokens FROM t, range(0, 100) r(c) WHERE c <= k""",
)
def equal_size_chunks(spark, folder):
    chunks = equal_chunks(whitespace_tokens(F.col("text")), 10, 3)
    rows = texts(spark, folder, "conversations", "conv_id").select("conv_id", "turn", F.posexplode(chunks).alias("chunk", "c"))
    return rows.select("conv_id", "turn", "chunk", _joined("c").alias("tokens"))


@query(
    "doubling_size_chunks",
    "ARR-11",
    "UDT-02",
    sql=f"""WITH t AS (SELECT conv_id, turn, {TOKENS_SQL} AS t, len({WORDS_SQL}) AS n FROM conversations),
k AS (SELECT *, len(list_filter(range(0, 30), lambda i: 8 * (2 ** (i + 1) - 1) + 3 <= n)) AS k FROM t)
SELECT conv_id, turn, c::INTEGER AS chunk, array_to_string(CASE WHEN c < k THEN t[(8 * (2 ** c - 1))::INTEGER + 1 : (8 * (2 ** (c + 1) - 1))::INTEGER + 3] ELSE t[(8 * (2 ** c - 1))::INTEGER + 1 :] END, ',') AS tokens FROM k, range(0, 30) r(c) WHERE c <= k""",
)
def doubling_size_chunks(spark, folder):
    chunks = doubling_chunks(whitespace_tokens(F.col("text")), 8, 3)
    rows = texts(spark, folder, "conversations", "conv_id").select("conv_id", "turn", F.posexplode(chunks).alias("chunk", "c"))
    return rows.select("conv_id", "turn", "chunk", _joined("c").alias("tokens"))


@query(
    "contained_runs",
    "ARR-12",
    sql=f"""WITH t AS (SELECT conv_id, turn, {TOKENS_SQL} AS t FROM conversations)
SELECT a.conv_id, a.turn, len(list_filter(range(0, greatest(len(a.t) - len(b.t[1:2]) + 1, 0)), lambda i: a.t[i + 1 : i + len(b.t[1:2])] = b.t[1:2])) > 0 AS contained
FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""",
)
def contained_runs(spark, folder):
    """Do the first two tokens of the next turn occur together in this one?"""
    turns = texts(spark, folder, "conversations", "conv_id").select("conv_id", "turn", whitespace_tokens(F.col("text")).alias("t"))
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.slice("t", 1, 2).alias("run"))
    return turns.join(following, ["conv_id", "turn"]).select("conv_id", "turn", contains_run(F.col("t"), F.col("run")).alias("contained"))


@query(
    "cross_faded_vectors",
    "ARR-13",
    sql=f"""SELECT vec_id, {_shown("list_transform(range(1, 9), lambda i: e[i] * ((i - 1) / 15.0::DOUBLE) + e[9 - i] * ((i + 7) / 15.0::DOUBLE)) || e[9:]")} AS samples FROM (SELECT vec_id, {_E} AS e FROM embeddings)""",
)
def cross_faded_vectors(spark, folder):
    """The vector fading in over the reversed vector, with a window of two times eight weights."""
    window = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: i / 15.0)
    rows = table(spark, folder, "embeddings").select("vec_id", cross_fade(F.col("embedding"), F.reverse("embedding"), window).alias("s"))
    return rows.select("vec_id", rounded_vector("s").alias("samples"))


def _resized_sql(n: int) -> str:
    at = f"greatest((i + 0.5::DOUBLE) * 64 / {n} - 0.5, 0)"
    low = f"least(floor({at}), 63)::INTEGER"
    return f"list_transform(range(0, {n}), lambda i: e[{low} + 1] * (1 - ({at} - {low})) + e[least({low} + 1, 63) + 1] * ({at} - {low}))"


@query(
    "resized_vectors",
    "ARR-14",
    sql=f"SELECT vec_id, {_shown(_resized_sql(25))} AS shorter, {_shown(_resized_sql(150))} AS longer FROM (SELECT vec_id, {_E} AS e FROM embeddings)",
)
def resized_vectors(spark, folder):
    vector = F.transform("embedding", lambda v: v.cast("double"))
    rows = table(spark, folder, "embeddings").select("vec_id", linear_resize(vector, 25).alias("a"), linear_resize(vector, 150).alias("b"))
    return rows.select("vec_id", rounded_vector("a").alias("shorter"), rounded_vector("b").alias("longer"))


@query(
    "token_validity",
    "ARR-15",
    sql=f"SELECT conv_id, turn, len(t) > 0 AND list_max(t) <= 9 AND len(t) = n AS valid FROM (SELECT conv_id, turn, {TOKENS_SQL} AS t, length(text) // 6 AS n FROM conversations)",
)
def token_validity(spark, folder):
    declared = F.floor(F.char_length("text") / 6)
    return texts(spark, folder, "conversations", "conv_id").select(
        "conv_id", "turn", valid_tokens(whitespace_tokens(F.col("text")), declared, 9).alias("valid")
    )


@query(
    "reassembled_chunks",
    "ARR-16",
    sql=f"""WITH c AS (SELECT vec_id // 4 AS request, vec_id, {_E} AS e FROM embeddings WHERE label <> 3)
SELECT request, {_shown("flatten(list(e ORDER BY vec_id))")} AS samples, sum(len(e)) / 16.0::DOUBLE AS duration FROM c GROUP BY 1
UNION ALL SELECT vec_id // 4, '', 0.0 FROM embeddings GROUP BY 1 HAVING count(*) FILTER (label <> 3) = 0""",
)
def reassembled_chunks(spark, folder):
    """Four vectors as the chunks of a request; vectors of label 3 arrive empty."""
    vectors = table(spark, folder, "embeddings")
    chunk = F.when(F.col("label") == 3, F.array().cast("array<float>")).otherwise(F.col("embedding"))
    rows = vectors.select(F.floor(F.col("vec_id") / 4).alias("request"), "vec_id", chunk.alias("chunk"))
    joined = reassembled(rows, "request", "vec_id", "chunk", 16)
    return joined.select("request", rounded_vector("samples").alias("samples"), "duration")


@query(
    "overlapping_chunks",
    "ARR-16",
    sql=f"""WITH c AS (SELECT vec_id // 2 AS request, list({_E} ORDER BY vec_id) AS cs FROM embeddings GROUP BY 1)
SELECT request, {_shown("CASE len(cs) WHEN 1 THEN cs[1] ELSE cs[1][1:56] || list_transform(range(1, 9), lambda i: cs[2][i] * ((i - 1) / 7.0::DOUBLE) + cs[1][56 + i] * (1 - (i - 1) / 7.0::DOUBLE)) || cs[2][9:] END")} AS samples FROM c""",
)
def overlapping_chunks(spark, folder):
    vectors = table(spark, folder, "embeddings").select(F.floor(F.col("vec_id") / 2).alias("request"), "vec_id", "embedding")
    joined = reassembled(vectors, "request", "vec_id", "embedding", 16, overlap=8)
    return joined.select("request", rounded_vector("samples").alias("samples"))


@query(
    "finite_json_rows",
    "JSN-01",
    sql="""SELECT p_partkey, sha256('{"p_name":"' || p_name || '","p_partkey":' || p_partkey || ',"p_size":' || p_size || '}') AS row_sha256 FROM part""",
)
def finite_json_rows(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    return parts.select("p_partkey", F.sha2(finite_json(parts, ["p_size", "p_partkey", "p_name"]), 256).alias("row_sha256"))
