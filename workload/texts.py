"""Documents, conversations, embeddings and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoweave.functions.links import extract_links
from chronoweave.functions.prompts import apply_template, chat_prompt, conversation_contexts, ends_with_stop
from chronoweave.functions.tokens import PatternTokenizer, pad_batches
from chronoweave.functions.vectors import argmax, f_measure, mean_best_cosine, token_vectors, unit
from chronoweave.operators.aggregates import linear_fit, project_capacity
from chronoweave.operators.columns import at_most_tokens
from chronoweave.operators.ordered import global_positions
from chronoweave.plans.samples import cut_after_overflow, discharge_samples, tokenise
from chronoweave.plans.splits import hold_out, shuffle_order, split_by_hash, split_chunks, split_counts, training_data
from chronoweave.session import stage
from chronoweave.sources.paging import batches
from chronoweave.sources.relational import spread
from chronoweave.spec import Wording
from workload.base import query, table

TOKENIZER = PatternTokenizer()
SYSTEM = "You answer briefly."
COUNT = "CAST(len(regexp_extract_all({0}, '[A-Za-z0-9_]+|[^A-Za-z0-9_ \\t\\n\\r]')) AS INTEGER)"
IDS = (
    "list_transform(regexp_extract_all({0}, '[A-Za-z0-9_]+|[^A-Za-z0-9_ \\t\\n\\r]'), "
    "lambda x: CAST(('0x' || substr(md5(x), 1, 8))::BIGINT % 32000 AS INTEGER))"
)


# --- documents -----------------------------------------------------------------------------


def documents(spark, sf, *columns):
    return spread(table(spark, sf, "documents").select(*columns))


@query("token_counts", f"SELECT doc_id, {COUNT.format('text')} AS n_tokens FROM documents")
def token_counts(spark, sf):
    return documents(spark, sf, "doc_id", "text").select("doc_id", TOKENIZER.count(F.col("text")).alias("n_tokens"))


@query("length_filter", f"SELECT doc_id, n_chars FROM documents WHERE {COUNT.format('text')} <= 300")
def length_filter(spark, sf):
    split = documents(spark, sf, "doc_id", "n_chars", "text").withColumn("tokens", TOKENIZER.tokens(F.col("text")))
    return split.where(at_most_tokens("tokens", 300)).select("doc_id", "n_chars")


@query(
    "token_totals",
    f"""SELECT lang, CAST(sum({COUNT.format('text')}) AS BIGINT) AS tokens, count(*) AS n_rows FROM documents GROUP BY lang
UNION ALL SELECT 'all', CAST(sum({COUNT.format('text')}) AS BIGINT), count(*) FROM documents""",
)
def token_totals(spark, sf):
    counted = documents(spark, sf, "lang", "text").select("lang", TOKENIZER.count(F.col("text")).alias("n"))
    per = counted.groupBy("lang").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("n_rows"))
    return per.unionByName(
        per.agg(F.sum("tokens").alias("tokens"), F.sum("n_rows").alias("n_rows")).withColumn("lang", F.lit("all"))
    )


@query(
    "prefix_cutoff",
    f"""WITH c AS (SELECT lang || '/' || (doc_id // 20) AS stay, doc_id % 20 AS number, {COUNT.format('text')} AS n_tokens FROM documents),
f AS (SELECT stay, min(number) AS first_over FROM c WHERE n_tokens > 800 GROUP BY stay)
SELECT c.* FROM c LEFT JOIN f USING (stay) WHERE n_tokens < 800 AND (first_over IS NULL OR number < first_over)""",
)
def prefix_cutoff(spark, sf):
    counted = documents(spark, sf, "doc_id", "lang", "text").select(
        F.concat_ws("/", "lang", F.floor(F.col("doc_id") / 20).cast("string")).alias("stay"),
        (F.col("doc_id") % 20).alias("number"),
        TOKENIZER.count(F.col("text")).alias("n_tokens"),
    )
    return cut_after_overflow(stage(counted), "stay", "number", "n_tokens", 800)


@query(
    "discharge_samples",
    """WITH l AS (SELECT doc_id, 1 AS k, 'quality ' || quality AS label FROM labels UNION ALL SELECT doc_id, 2, 'toxic ' || toxic FROM labels),
g AS (SELECT doc_id, string_agg(' - ' || label || chr(10), '' ORDER BY k) AS lines FROM l GROUP BY doc_id
)
SELECT doc_id || '_discharge' AS sample_id, source AS subject_id, doc_id AS stay_id,
  'language: ' || lang || chr(10) || chr(10) || 'note: ' || text || chr(10) || chr(10) || chr(10) || 'Which labels fit?' AS input,
  'Potential labels:' || chr(10) || lines || chr(10) AS output FROM documents JOIN g USING (doc_id)""",
)
def discharge_query(spark, sf):
    from chronoweave.functions import text as lines

    stays = table(spark, sf, "documents").select(
        F.col("doc_id").alias("stay_id"), F.col("source").alias("subject_id"), "lang", "text"
    )
    pair = F.array(
        F.struct(F.lit(1).alias("k"), F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("label")),
        F.struct(F.lit(2).alias("k"), F.concat(F.lit("toxic "), F.col("toxic").cast("string")).alias("label")),
    )
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("stay_id"), F.inline(pair))
    return discharge_samples(
        stays, labels, preamble=lines.block([("language", F.col("lang"))]), note="text", label="label", tie=["k"],
        question="Which labels fit?", heading="Potential labels",
    )


FITS = (8, 16, 32, 128, 256, 512, 1024, 2048, 4096, 8192)  # rows in a batch, multiples of the first
BUDGET, AT = 1 << 35, 500_000  # bytes, rows


@query(
    "payload_fit",
    f"""WITH d AS (SELECT strlen(text) AS bytes, row_number() OVER (ORDER BY doc_id) AS pos FROM documents),
b AS (SELECT n, (pos - 1) // n AS batch, count(*) AS n_rows, sum(bytes) AS bytes FROM d, (SELECT unnest({list(FITS)}) AS n) GROUP BY 1, 2),
f AS (SELECT regr_slope(bytes, n_rows) AS slope, regr_intercept(bytes, n_rows) AS intercept FROM b)
SELECT round(slope, 4) AS slope, round(intercept, 4) + 0.0 AS intercept, round(({BUDGET} - intercept) / slope, 2) AS x_at_budget,
  round(intercept + slope * {AT}, 2) AS y_at_x FROM f""",
)
def payload_fit(spark, sf):
    """Bytes per batch of rows for several batch sizes over the whole table, and the line through them."""
    sizes = table(spark, sf, "documents").select("doc_id", F.octet_length("text").alias("bytes"))
    placed = global_positions(sizes, ["doc_id"], "pos")
    least = FITS[0]
    blocks = placed.groupBy(F.floor((F.col("pos") - 1) / least).alias("block")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("bytes").alias("bytes"))
    # Every batch is made of whole blocks, so blocks are counted once per size, not rows.
    each = blocks.select("block", "n_rows", "bytes", F.explode(F.array(*[F.lit(n) for n in FITS])).alias("n"))
    per_batch = each.groupBy("n", F.floor(F.col("block") * least / F.col("n")).alias("batch")).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("bytes").alias("bytes")
    )
    fit = project_capacity(linear_fit(per_batch, "n_rows", "bytes"), BUDGET, AT)
    return fit.select(
        F.round("slope", 4).alias("slope"), (F.round("intercept", 4) + 0.0).alias("intercept"),
        F.round("x_at_budget", 2).alias("x_at_budget"), F.round("y_at_x", 2).alias("y_at_x"),
    )


FRACTION = "('0x' || substr(md5('7:' || {0}), 1, 8))::BIGINT / 4294967296.0"


@query("split_hash", f"SELECT doc_id, CASE WHEN {FRACTION.format('doc_id')} < 0.2 THEN 'test' ELSE 'train' END AS split FROM documents")
def split_hash(spark, sf):
    return split_by_hash(table(spark, sf, "documents").select("doc_id"), "doc_id", 0.2, seed=7)


@query(
    "split_exact",
    """WITH p AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 150 AS chunk FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY md5('7:' || doc_id), doc_id) AS rank, count(*) OVER (PARTITION BY chunk) AS n FROM p)
SELECT doc_id, chunk, CASE WHEN rank <= ceil(n * CAST(0.2 AS DECIMAL(18,9))) THEN 'test' ELSE 'train' END AS split FROM r""",
)
def split_exact(spark, sf):
    return split_chunks(table(spark, sf, "documents").select("doc_id"), ["doc_id"], "doc_id", 150, 0.2, seed=7)


@query(
    "split_by_subject",
    f"SELECT event_id, user_id, CASE WHEN {FRACTION.format('user_id')} < 0.2 THEN 'test' ELSE 'train' END AS split FROM events",
)
def split_by_subject(spark, sf):
    return split_by_hash(table(spark, sf, "events").select("event_id", "user_id"), "user_id", 0.2, seed=7)


@query(
    "holdout",
    """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) AS pos, count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN pos <= floor(n * CAST(0.1 AS DECIMAL(18,9))) THEN 'validation' ELSE 'train' END AS split FROM r""",
)
def holdout(spark, sf):
    return hold_out(table(spark, sf, "documents").select("doc_id"), "doc_id", 0.1, seed=7)


@query("shuffle_order", "SELECT doc_id, row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) AS position FROM documents")
def shuffle_query(spark, sf):
    return shuffle_order(table(spark, sf, "documents").select("doc_id"), "doc_id", seed=7)


@query(
    "dataset_counts",
    """WITH r AS (SELECT row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) AS pos, count(*) OVER () AS n FROM documents)
SELECT CASE WHEN pos <= floor(n * CAST(0.1 AS DECIMAL(18,9))) THEN 'validation' ELSE 'train' END AS split, count(*) AS n_rows FROM r GROUP BY 1""",
)
def dataset_counts(spark, sf):
    return split_counts(holdout(spark, sf))


# --- conversations ---------------------------------------------------------------------------

PAIRS_SQL = """pairs AS (SELECT u.conv_id, u.turn, u.text AS input, a.text AS output FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' WHERE u.role = 'user')"""
PROMPT_SQL = """'<|im_start|>system' || chr(10) || 'You answer briefly.' || chr(10) || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10)
  || input || chr(10) || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)"""


def pairs(spark, sf):
    """A user turn and the assistant turn right after it."""
    turns = table(spark, sf, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("input"))
    answered = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    return asked.join(answered, ["conv_id", "turn"])


@query(
    "chat_prompt",
    f"""WITH {PAIRS_SQL} SELECT conv_id, turn, {PROMPT_SQL} AS head, output || chr(10) || '<|im_end|></s>' AS tail,
  {PROMPT_SQL} || output || chr(10) || '<|im_end|></s>' AS prompt FROM pairs""",
)
def chat_prompt_query(spark, sf):
    parts = chat_prompt(SYSTEM, F.col("input"), F.col("output"), separate=True)
    whole = chat_prompt(SYSTEM, F.col("input"), F.col("output"))
    return pairs(spark, sf).select(
        "conv_id", "turn", parts["input"].alias("head"), parts["output"].alias("tail"), whole.alias("prompt")
    )


CONTEXT_SQL = """WITH m AS (SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS body FROM conversations),
o AS (SELECT '<|im_start|>system' || chr(10) || 'You answer briefly.<|im_end|>' || chr(10) AS opening, '<|im_start|>assistant' || chr(10) AS closing),
asked AS (SELECT conv_id, turn FROM m WHERE role = 'user'),
ctx AS (SELECT a.conv_id, a.turn, CAST(count(*) + 1 AS INTEGER) AS n_messages,
  any_value(o.opening) || string_agg(m.body, '' ORDER BY m.turn) || any_value(o.closing) AS prompt
  FROM asked a JOIN m ON m.conv_id = a.conv_id AND m.turn <= a.turn, o GROUP BY a.conv_id, a.turn)"""


def contexts(spark, sf):
    return conversation_contexts(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text", system=SYSTEM)


@query("conversation_context", f"{CONTEXT_SQL} SELECT conv_id, turn, n_messages FROM ctx")
def conversation_context(spark, sf):
    return contexts(spark, sf).select("conv_id", "turn", F.size("messages").alias("n_messages"))


@query("chat_template", f"{CONTEXT_SQL} SELECT conv_id, turn, prompt FROM ctx")
def chat_template(spark, sf):
    return contexts(spark, sf).select(
        "conv_id", "turn", apply_template(F.col("messages"), add_generation_prompt=True).alias("prompt")
    )


@query(
    "tokenised_samples",
    f"""WITH {PAIRS_SQL}, p AS (SELECT conv_id || '_' || turn AS sample_id,
  '<|im_start|>system' || chr(10) || 'You read the course of a stay and say what comes next.' || chr(10) || '<|im_end|>' || chr(10)
  || '<|im_start|>user' || chr(10) || input || chr(10) || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)
  || output || chr(10) || '<|im_end|></s>' AS prompt FROM pairs)
SELECT sample_id, array_to_string({IDS.format('prompt')}, ' ') AS ids, {COUNT.format('prompt')} AS token_count FROM p""",
)
def tokenised(spark, sf):
    samples = pairs(spark, sf).withColumn("sample_id", F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    rows = tokenise(samples, TOKENIZER, Wording())
    return rows.select("sample_id", F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("ids"), "token_count")


@query(
    "training_data",
    f"""WITH t AS (SELECT doc_id, {COUNT.format('text')} AS n_tokens FROM documents WHERE {COUNT.format('text')} <= 900),
r AS (SELECT *, row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) AS position, count(*) OVER () AS n FROM t)
SELECT doc_id, n_tokens, position,
  CASE WHEN position <= floor(n * CAST(0.1 AS DECIMAL(18,9))) THEN 'validation' ELSE 'train' END AS split FROM r""",
)
def training_data_query(spark, sf):
    rows = documents(spark, sf, "doc_id", "text").select("doc_id", TOKENIZER.ids(F.col("text")).alias("input_ids"))
    loaded = training_data(stage(rows), "doc_id", "input_ids", max_tokens=900, share=0.1, seed=7)
    return loaded.select("doc_id", F.size("input_ids").alias("n_tokens"), "position", "split")


@query(
    "pad_batches",
    f"""WITH r AS (SELECT conv_id, turn, {IDS.format('text')} AS ids,
  (row_number() OVER (ORDER BY conv_id, turn) - 1) // 16 AS batch FROM conversations),
w AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) AS width FROM r),
p AS (SELECT *, list_transform(range(width - len(ids)), lambda x: 0) AS zeros, list_transform(range(width - len(ids)), lambda x: -100) AS ignored,
  list_transform(ids, lambda x: 1) AS ones FROM w)
SELECT conv_id, turn, batch, width, array_to_string(list_concat(ids, zeros), ' ') AS input_ids,
  array_to_string(list_concat(ones, zeros), ' ') AS attention_mask,
  array_to_string(list_concat(list_transform(ids, lambda x: CASE WHEN x = 0 THEN -100 ELSE x END), ignored), ' ') AS labels FROM p""",
)
def pad_query(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", TOKENIZER.ids(F.col("text")).alias("ids"))
    padded = pad_batches(batches(turns, ["conv_id", "turn"], 16, unique=True), "batch", "ids")
    listed = [F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("input_ids", "attention_mask", "labels")]
    return padded.select("conv_id", "turn", "batch", F.col("width").cast("bigint").alias("width"), *listed)


@query(
    "stop_sequence",
    """WITH h AS (SELECT conv_id, CASE WHEN length(text) >= 9 AND contains(right(text, 9), 'que.') THEN 1 ELSE 0 END
  + CASE WHEN length(text) >= 8 AND contains(right(text, 8), 'en.') THEN 1 ELSE 0 END AS hits FROM conversations)
SELECT conv_id, CAST(sum(hits) AS BIGINT) AS hits, sum(hits) >= 2 AS stopped FROM h GROUP BY conv_id""",
)
def stop_sequence(spark, sf):
    hits = ends_with_stop(F.col("text"), ["que.", "en."])
    found = table(spark, sf, "conversations").groupBy("conv_id").agg(F.sum(hits).alias("hits"))
    return found.withColumn("stopped", F.col("hits") >= 2)


# --- embeddings and pages ----------------------------------------------------------------------


@query("argmax_label", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS best FROM embeddings")
def argmax_label(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", argmax(F.col("embedding")).alias("best"))


@query(
    "greedy_similarity",
    """WITH tok AS (SELECT vec_id, i, list_slice(CAST(embedding AS DOUBLE[]), i * 8 + 1, i * 8 + 8) AS v FROM embeddings, range(8) r(i)),
c AS (SELECT a.vec_id, a.i AS i, b.i AS j, list_cosine_similarity(a.v, b.v) AS s FROM tok a JOIN tok b ON b.vec_id = a.vec_id + 1),
p AS (SELECT vec_id, avg(s) AS p FROM (SELECT vec_id, i, max(s) AS s FROM c GROUP BY 1, 2) GROUP BY 1),
r AS (SELECT vec_id, avg(s) AS r FROM (SELECT vec_id, j, max(s) AS s FROM c GROUP BY 1, 2) GROUP BY 1)
SELECT vec_id, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1 FROM p JOIN r USING (vec_id)""",
)
def greedy_similarity(spark, sf):
    """Each embedding is eight token vectors of one text; its reference is the next text."""
    vectors = spread(table(spark, sf, "embeddings").select("vec_id", "embedding")).select(
        "vec_id", F.transform(token_vectors(F.col("embedding"), 8), unit).alias("tokens")
    )
    reference = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("tokens").alias("reference"))
    scored = vectors.join(reference, "vec_id").select(
        "vec_id",
        mean_best_cosine(F.col("tokens"), F.col("reference")).alias("p"),
        mean_best_cosine(F.col("reference"), F.col("tokens")).alias("r"),
    )
    return scored.select(
        "vec_id", F.round("p", 6).alias("precision"), F.round("r", 6).alias("recall"),
        F.round(f_measure(F.col("p"), F.col("r")), 6).alias("f1"),
    )


@query(
    "extract_links",
    r"""WITH t AS (SELECT page_id, url, regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'g') AS tags FROM pages),
h AS (SELECT page_id, url,
  regexp_extract_all(tags, '(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|''([^'']*)'')', 1) AS d,
  regexp_extract_all(tags, '(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|''([^'']*)'')', 2) AS s FROM t),
e AS (SELECT page_id, url, unnest(d) AS d, unnest(s) AS s, CAST(generate_subscripts(d, 1) - 1 AS INTEGER) AS position FROM h),
l AS (SELECT page_id, position, replace(replace(replace(replace(replace(CASE WHEN d <> '' THEN d ELSE s END,
    '&quot;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS href,
  regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*:)', 1) AS scheme, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS origin,
  regexp_replace(url, '[?#].*$', '') AS clean, regexp_replace(url, '#.*$', '') AS whole FROM e)
SELECT page_id, position, href, CASE WHEN href LIKE '%/' THEN 'directory' ELSE 'file' END AS kind,
  CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href WHEN href LIKE '//%' THEN scheme || href
    WHEN href LIKE '/%' THEN origin || href WHEN href LIKE '?%' THEN clean || href WHEN href LIKE '#%' THEN whole || href
    WHEN href = '' THEN whole
    ELSE origin || coalesce(nullif(regexp_replace(regexp_replace(clean, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '[^/]*$', ''), ''), '/') || href
  END AS address FROM l WHERE href <> '../'""",
)
def extract_links_query(spark, sf):
    return extract_links(spread(table(spark, sf, "pages")), "page_id", "url", "html")
