"""Tokens, vocabularies, id sequences and sparse vectors."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from textloom.functions import sequences as seq
from textloom.functions.text import (
    KERAS_FILTERS,
    KERAS_FILTERS_KEEP_MARKERS,
    STRIP_PUNCTUATION,
    sequence_tokens,
    stripped_tokens,
    word_tokens,
    wrap,
)
from textloom.operators import vectorize, vocabulary as voc
from textloom.operators.lookup import keyed_lookup
from textloom.operators.ml import word_vectors
from textloom.operators.skipgram import word_counts
from textloom.plans.cleaning import pairs
from textloom.plans.registry import PAIRS, query, sql_text
from textloom.sources.files import load_vocabulary, save_vocabulary
from textloom.sources.scratch import materialize, new_path
from textloom.sources.tables import load

MAX_TOKENS = 20_000
SEQUENCE_LENGTH = 100
VECTOR_LENGTH = 128
NUM_WORDS = 10_000


def _sql_translate(text: str, chars: str, fill: str) -> str:
    escaped = sql_text(chars.replace("\t", "").replace("\n", ""))
    extra = "".join(f" || chr({ord(c)})" for c in "\t\n" if c in chars)
    return f"translate(lower({text}), {escaped}{extra}, {sql_text(fill * len(chars))})"


def sequence_sql(text: str, filters: str = KERAS_FILTERS) -> str:
    return f"list_filter(string_split({_sql_translate(text, filters, ' ')}, ' '), lambda t: t <> '')"


def stripped_sql(text: str) -> str:
    bare = _sql_translate(text, STRIP_PUNCTUATION, "")
    return f"list_filter(regexp_split_to_array({bare}, '\\s+'), lambda t: t <> '')"


def word_sql(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"


def _ranked(source: str, offset: int, limit: int | None = None) -> str:
    cap = f" WHERE rk <= {limit}" if limit is not None else ""
    return (
        f"(SELECT token, n, rk + {offset} AS token_id FROM (SELECT token, n, "
        f"row_number() OVER (ORDER BY n DESC, token) AS rk FROM {source}){cap})"
    )


# Shared vocabulary of questions and answers, the tokens of the pairs, and their ids.
PAIR_TOKENS = f"""{PAIRS},
ptokens AS (SELECT pair_id, unnest({sequence_sql('question')}) AS token FROM pairs
            UNION ALL SELECT pair_id, unnest({sequence_sql('answer')}) FROM pairs),
pcounts AS (SELECT token, count(*) AS n FROM ptokens GROUP BY token),
pvocab AS {_ranked('pcounts', 0)},
qseq AS (SELECT pair_id, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS token
         FROM (SELECT pair_id, {sequence_sql('question')} AS t FROM pairs)),
qids AS (SELECT p.pair_id, coalesce(s.ids, []) AS ids FROM pairs p LEFT JOIN (
           SELECT pair_id, list(token_id ORDER BY pos) AS ids FROM qseq JOIN pvocab USING (token) GROUP BY pair_id) s
         USING (pair_id))"""


def pair_vocabulary(spark, sf, pair_rows):
    tokens = voc.joint_tokens(pair_rows, "pair_id", ["question", "answer"], sequence_tokens)
    return voc.build_vocabulary(voc.token_counts(tokens))


def question_ids(spark, sf):
    pair_rows = pairs(spark, sf)
    vocab = pair_vocabulary(spark, sf, pair_rows)
    tokens = voc.token_rows(pair_rows, "pair_id", sequence_tokens("question"))
    return voc.sequences(voc.tokens_to_ids(tokens, vocab), pair_rows, "pair_id"), vocab, pair_rows


@query(
    "vocab_keras",
    f"""WITH tokens AS (SELECT unnest({sequence_sql('text')}) AS token FROM documents),
        counts AS (SELECT token, count(*) AS n FROM tokens GROUP BY token) SELECT * FROM {_ranked('counts', 0)}""",
)
def vocab_keras(spark, sf):
    """Uncapped vocabulary of the documents, saved and loaded back."""
    tokens = voc.token_rows(load(spark, sf, "documents"), "doc_id", sequence_tokens("text"), spread=None)
    path = new_path(spark, "saved-vocab")
    save_vocabulary(voc.build_vocabulary(voc.token_counts(tokens)), path)
    return load_vocabulary(spark, path)


@query("vocab_joint", f"WITH {PAIR_TOKENS} SELECT token, n, token_id FROM pvocab")
def vocab_joint(spark, sf):
    return pair_vocabulary(spark, sf, pairs(spark, sf)).select("token", "n", "token_id")


@query("seq_keras", f"WITH {PAIR_TOKENS} SELECT pair_id, array_to_string(ids, ' ') AS ids FROM qids")
def seq_keras(spark, sf):
    ids, _, _ = question_ids(spark, sf)
    return ids.select("pair_id", seq.render("ids").alias("ids"))


DOC_OOV = f"""dseq AS (SELECT doc_id, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS token
         FROM (SELECT doc_id, {sequence_sql('text')} AS t FROM documents)),
dcounts AS (SELECT token, count(*) AS n FROM dseq GROUP BY token),
dvocab AS {_ranked('dcounts', 1)},
dids AS (SELECT doc_id, list(coalesce(CASE WHEN token_id < {NUM_WORDS} THEN token_id END, 1) ORDER BY pos) AS ids
         FROM dseq LEFT JOIN dvocab USING (token) GROUP BY doc_id)"""


@query(
    "seq_oov",
    f"""WITH {DOC_OOV} SELECT doc_id, coalesce(len(ids), 0)::BIGINT AS n,
          coalesce(array_to_string(ids, ' '), '') AS ids FROM documents LEFT JOIN dids USING (doc_id)""",
)
def seq_oov(spark, sf):
    """Whole documents as ids, unknown words and words past the cap on id 1."""
    docs = load(spark, sf, "documents")
    counted = voc.token_rows(docs, "doc_id", sequence_tokens("text"), spread=None)
    vocab = voc.build_vocabulary(voc.token_counts(counted), max_tokens=NUM_WORDS, oov_token=voc.OOV)
    tokens = voc.token_rows(docs, "doc_id", sequence_tokens("text"))
    ids = voc.tokens_to_ids(tokens, vocab, oov_id=1, num_words=NUM_WORDS)
    return voc.sequences(ids, docs, "doc_id").select(
        "doc_id", F.size("ids").cast("bigint").alias("n"), seq.render("ids").alias("ids")
    )


def _sql_pad(padding: str, truncating: str, length: int) -> str:
    kept = f"ids[greatest(len(ids) - {length}, 0) + 1:]" if truncating == "pre" else f"ids[1:{length}]"
    fill = f"list_resize([]::BIGINT[], greatest({length} - len(ids), 0), 0)"
    both = f"{fill} || {kept}" if padding == "pre" else f"{kept} || {fill}"
    return f"array_to_string({both}, ' ')"


@query(
    "seq_pad",
    f"""WITH {PAIR_TOKENS} SELECT pair_id, {_sql_pad('pre', 'pre', 12)} AS pre_pre,
          {_sql_pad('post', 'pre', 12)} AS post_pre, {_sql_pad('post', 'post', 12)} AS post_post,
          {_sql_pad('pre', 'pre', SEQUENCE_LENGTH)} AS full_pre FROM qids""",
)
def seq_pad(spark, sf):
    ids, _, _ = question_ids(spark, sf)
    return ids.select(
        "pair_id",
        seq.render(seq.pad_sequence("ids", 12)).alias("pre_pre"),
        seq.render(seq.pad_sequence("ids", 12, padding="post")).alias("post_pre"),
        seq.render(seq.pad_sequence("ids", 12, padding="post", truncating="post")).alias("post_post"),
        seq.render(seq.pad_sequence("ids", SEQUENCE_LENGTH)).alias("full_pre"),
    )


MARKED = f"""{PAIRS},
aseq AS (SELECT pair_id, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS token FROM (
           SELECT pair_id, {sequence_sql("'<start> ' || answer || ' <end>'", KERAS_FILTERS_KEEP_MARKERS)} AS t FROM pairs)),
acounts AS (SELECT token, count(*) AS n FROM aseq GROUP BY token),
avocab AS {_ranked('acounts', 0)},
aids AS (SELECT pair_id, list(token_id ORDER BY pos) AS ids FROM aseq JOIN avocab USING (token) GROUP BY pair_id)"""


def answer_ids(spark, sf):
    """Answers between start and end markers, as ids of their own vocabulary."""
    marked = pairs(spark, sf).withColumn("marked", wrap("answer"))
    tokens = voc.token_rows(marked, "pair_id", sequence_tokens("marked", KERAS_FILTERS_KEEP_MARKERS))
    vocab = voc.build_vocabulary(voc.token_counts(tokens))
    return voc.sequences(voc.tokens_to_ids(tokens, vocab), marked, "pair_id"), vocab


@query(
    "seq_shift",
    f"""WITH {MARKED} SELECT pair_id, array_to_string(ids[1:len(ids) - 1], ' ') AS decoder_input,
          array_to_string(ids[2:], ' ') AS decoder_target, array_to_string(ids[2:] || [0], ' ') AS shifted FROM aids""",
)
def seq_shift(spark, sf):
    ids, _ = answer_ids(spark, sf)
    return ids.select(
        "pair_id",
        seq.render(seq.drop_last("ids")).alias("decoder_input"),
        seq.render(seq.drop_first("ids")).alias("decoder_target"),
        seq.render(seq.shift_left("ids")).alias("shifted"),
    )


@query(
    "seq_decode",
    f"""WITH {MARKED}, upto AS (SELECT pair_id, min(pos) AS stop FROM aseq WHERE token = '<end>' GROUP BY pair_id)
        SELECT pair_id, coalesce(string_agg(token, ' ' ORDER BY pos), '') AS text
        FROM aseq JOIN upto USING (pair_id) WHERE pos < stop GROUP BY pair_id""",
)
def seq_decode(spark, sf):
    ids, vocab = answer_ids(spark, sf)
    padded = ids.select("pair_id", F.concat("ids", F.array(F.lit(0).cast("bigint"))).alias("ids"))
    return voc.decode(padded, vocab, "pair_id", stop_token="<end>")


@query(
    "seq_bounds",
    f"""WITH {PAIR_TOKENS} SELECT max(list_max(ids)) AS max_id, (SELECT max(token_id) + 1 FROM pvocab) AS vocab_size,
          max(list_max(ids)) < (SELECT max(token_id) + 1 FROM pvocab) AS in_range FROM qids""",
)
def seq_bounds(spark, sf):
    ids, vocab, _ = question_ids(spark, sf)
    return voc.bounds_report(ids, vocab)


def vectorizer_sql(first: int, tokens: str = "", max_tokens: int = MAX_TOKENS) -> str:
    tokens = tokens or stripped_sql("text")
    return f"""toks AS (SELECT doc_id, {tokens} AS t FROM documents),
  occ AS (SELECT doc_id, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS token FROM toks),
  counts AS (SELECT token, count(*) AS n FROM occ GROUP BY token),
  vocab AS {_ranked('counts', first - 1, max_tokens - first)},
  vec AS (SELECT doc_id, coalesce(token_id, 0) AS token_id, count(*) AS n FROM occ LEFT JOIN vocab USING (token)
          GROUP BY ALL)"""


BIGRAMS_SQL = (
    "(SELECT t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) FROM (SELECT "
    + stripped_sql("text")
    + " AS t))"
)


def document_tokens(spark, sf, bigrams: bool = False, spread: bool | None = True):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    return voc.token_rows(docs, "doc_id", stripped_tokens("text"), bigrams=bigrams, spread=spread)


def document_vocabulary(spark, sf, first_id: int = 1, bigrams: bool = False):
    counts = voc.token_counts(document_tokens(spark, sf, bigrams, spread=None))
    return voc.build_vocabulary(counts, first_id=first_id, max_tokens=MAX_TOKENS)


@query("vocab_tv", f"WITH {vectorizer_sql(1)} SELECT token, n, token_id FROM vocab")
def vocab_tv(spark, sf):
    return document_vocabulary(spark, sf).select("token", "n", "token_id")


@query(
    "vec_int",
    f"""WITH {vectorizer_sql(2)}, ids AS (
          SELECT doc_id, list(coalesce(token_id, 1) ORDER BY pos) AS ids FROM occ LEFT JOIN vocab USING (token) GROUP BY doc_id)
        SELECT doc_id, {_sql_pad('post', 'post', VECTOR_LENGTH)} AS ids FROM (
          SELECT doc_id, coalesce(ids, []) AS ids FROM documents LEFT JOIN ids USING (doc_id))""",
)
def vec_int(spark, sf):
    """Ids with 0 = padding and 1 = unknown at the fixed output length of the vectorizer."""
    docs = load(spark, sf, "documents")
    tokens = document_tokens(spark, sf)
    vocab = document_vocabulary(spark, sf, first_id=2)
    # Only cells inside the output length are looked up; the vocabulary counts all of them.
    ids = voc.tokens_to_ids(tokens.filter(F.col("pos") < VECTOR_LENGTH), vocab, oov_id=1)
    return voc.sequences(ids, docs, "doc_id").select(
        "doc_id",
        seq.render(seq.pad_sequence("ids", VECTOR_LENGTH, padding="post", truncating="post")).alias("ids"),
    )


@query("vec_multihot", f"WITH {vectorizer_sql(1)} SELECT doc_id, token_id, 1::INT AS hot FROM vec")
def vec_multihot(spark, sf):
    return vectorize.multi_hot_vectors(document_tokens(spark, sf), document_vocabulary(spark, sf), "doc_id")


@query("vec_count", f"WITH {vectorizer_sql(1)} SELECT doc_id, token_id, n::BIGINT AS n FROM vec")
def vec_count(spark, sf):
    return vectorize.count_vectors(document_tokens(spark, sf), document_vocabulary(spark, sf), "doc_id")


@query("vec_bigram", f"WITH {vectorizer_sql(1, BIGRAMS_SQL)} SELECT doc_id, token_id, n::BIGINT AS n FROM vec")
def vec_bigram(spark, sf):
    vocab = document_vocabulary(spark, sf, bigrams=True)
    return vectorize.count_vectors(document_tokens(spark, sf, bigrams=True), vocab, "doc_id")


@query(
    "vec_tfidf_keras",
    f"""WITH {vectorizer_sql(1, BIGRAMS_SQL)},
        df AS (SELECT token_id, count(*) AS df FROM vec WHERE token_id > 0 GROUP BY token_id),
        idf AS (SELECT token_id, ln(1 + (SELECT count(*) FROM documents) / (1.0::DOUBLE + df)) AS idf FROM df),
        every AS (SELECT * FROM idf UNION ALL SELECT 0, avg(idf) FROM idf)
        SELECT doc_id, token_id, round(n * idf, 6) AS weight FROM vec JOIN every USING (token_id)""",
)
def vec_tfidf_keras(spark, sf):
    counts = materialize(vectorize.text_token_counts(document_tokens(spark, sf, bigrams=True), "doc_id"), "token-counts")
    n_docs = load(spark, sf, "documents").agg(F.count(F.lit(1)))
    vocab = voc.build_vocabulary(voc.count_statistics(counts), max_tokens=MAX_TOKENS)
    vectors = vectorize.tfidf_vectors(counts, vocab, n_docs, "doc_id")
    return vectors.withColumn("weight", F.round("weight", 6))


def unit_sql(source: str, key: str, text: str) -> str:
    return f"""tf AS (SELECT {key}, token, count(*) AS tf FROM (
            SELECT {key}, unnest({word_sql(text)}) AS token FROM {source}) GROUP BY ALL),
  idf AS (SELECT token, ln((1.0::DOUBLE + (SELECT count(*) FROM {source})) / (1.0::DOUBLE + count(*))) + 1 AS idf
          FROM tf GROUP BY token),
  raw AS (SELECT {key}, token, tf * idf AS w FROM tf JOIN idf USING (token)),
  unit AS (SELECT {key}, token, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM raw)"""


@query(
    "vec_tfidf_l2",
    f"WITH {unit_sql('documents', 'doc_id', 'text')} SELECT doc_id, token, round(weight, 6) AS weight FROM unit",
)
def vec_tfidf_l2(spark, sf):
    vectors, _ = _unit_vectors(spark, sf)
    return vectors.withColumn("weight", F.round("weight", 6))


def _unit_vectors(spark, sf):
    docs = load(spark, sf, "documents")
    tokens = voc.token_rows(docs, "doc_id", word_tokens("text"))
    counts = materialize(vectorize.text_token_counts(tokens, "doc_id"), "token-counts")
    idf = vectorize.smooth_idf(counts, docs.agg(F.count(F.lit(1))))
    return vectorize.unit_tfidf(counts, idf, "doc_id"), idf


WIDE = 20


@query(
    "vec_wide",
    f"""WITH {unit_sql('documents', 'doc_id', 'text')},
        terms AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) AS place FROM tf GROUP BY token),
        wide AS (SELECT doc_id, """
    + ", ".join(f"round(coalesce(sum(weight) FILTER (place = {i}), 0), 6) AS term_{i}" for i in range(1, WIDE + 1))
    + """ FROM unit JOIN terms USING (token) GROUP BY doc_id)
        SELECT wide.*, lang FROM wide JOIN documents USING (doc_id)""",
)
def vec_wide(spark, sf):
    """The most frequent terms as columns, with the class of the document."""
    vectors, idf = _unit_vectors(spark, sf)
    wide = vectorize.wide_table(vectors, vectorize.frequent_terms(idf, WIDE), WIDE, "doc_id")
    rounded = [F.round(f"term_{i}", 6).alias(f"term_{i}") for i in range(1, WIDE + 1)]
    classes = load(spark, sf, "documents").select("doc_id", "lang")
    return wide.select("doc_id", *rounded).join(classes, "doc_id")


@query("embed_w2v")
def embed_w2v(spark, sf):
    """Word2Vec text vectors: the mean of the word vectors of each document."""
    docs = load(spark, sf, "documents").select("doc_id", "lang", stripped_tokens("text").alias("tokens"))
    return word_vectors(docs, "tokens").transform(docs).select("doc_id", "lang", "embedding")


@query("embed_w2v_is_mean", "SELECT count(*) AS n, true AS all_close FROM documents")
def embed_w2v_is_mean(spark, sf):
    """Every text vector equals the mean of its words' vectors, rare words included; zero without words."""
    docs = materialize(load(spark, sf, "documents").select("doc_id", stripped_tokens("text").alias("tokens")), "w2v-tokens")
    counts = word_counts(docs, "tokens")
    model = word_vectors(docs, "tokens", counts=counts)
    vectors = model.getVectors().select("word", vector_to_array("vector", "float32").alias("w"))
    words = materialize(vectors.join(counts.withColumnRenamed("token", "word"), "word"), "word-vectors")
    size = model.getVectorSize()
    # A word's vector comes in one piece, and so does the sum; the words of a text lie together, so they are added up where they are.
    found = keyed_lookup(docs.select("doc_id", F.explode("tokens").alias("word")), words, "word", "n")
    sums = found.groupBy("doc_id").agg(*[F.sum(F.col("w")[i].cast("double")).alias(f"s{i}") for i in range(size)])
    lengths = docs.select("doc_id", F.size("tokens").alias("length"))
    cells = model.transform(docs).select("doc_id", vector_to_array("embedding").alias("x"))
    both = cells.join(lengths, "doc_id").join(sums, "doc_id", "left")
    longest = F.greatest(F.col("length"), F.lit(1))
    far = F.max(F.greatest(*[F.abs(F.col("x")[i] - F.coalesce(F.col(f"s{i}"), F.lit(0.0)) / longest) for i in range(size)]))
    return both.groupBy("doc_id").agg(far.alias("far")).agg(
        F.count(F.lit(1)).alias("n"), (F.max("far") < 1e-6).alias("all_close")
    )
