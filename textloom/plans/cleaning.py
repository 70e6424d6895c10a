"""Sources, cleaning, profiling and ordered picks."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from textloom.functions.text import combine, space_word_count, unify_length, whitespace_tokens
from textloom.operators import cleaning, ranking, sketches
from textloom.operators.qa import extract_pairs
from textloom.plans.registry import LABELLED, PAIRS, query
from textloom.sources import files, records
from textloom.sources.scratch import materialize, new_path
from textloom.sources.tables import faq_pairs, labelled_documents, load


#: Pairs in one file of ``json_array``.
ARRAY_ROWS = 500_000


def pairs(spark, sf):
    return faq_pairs(load(spark, sf, "conversations"))


def labelled(spark, sf):
    return labelled_documents(load(spark, sf, "documents"), load(spark, sf, "labels"))


@query("csv_roundtrip", f"WITH {PAIRS} SELECT question, answer, length(answer)::BIGINT AS answer_chars FROM pairs")
def csv_roundtrip(spark, sf):
    """Written with another order of columns and one more; read back by name."""
    path = new_path(spark, "faq-csv")
    files.write_csv(pairs(spark, sf).select("pair_id", "answer", "question"), path)
    back = files.read_csv(spark, path, files.FAQ, multi_line=True)
    return back.withColumn("answer_chars", F.length("answer").cast("bigint"))


@query(
    "json_roundtrip",
    f"WITH {PAIRS} SELECT question, answer, length(question) < 60 AS found_duplicate FROM pairs",
)
def json_roundtrip(spark, sf):
    """Arrays of at most 1000 question/answer objects, read back to rows."""
    path = new_path(spark, "faq-json")
    flagged = pairs(spark, sf).select(
        "conv_id", F.floor(F.col("turn") / 1000).alias("part"),
        "question", "answer", (F.length("question") < 60).alias("found_duplicate"),
    )
    files.write_json_arrays(flagged, path, "conv_id", "part")
    return files.read_json_lines(spark, path, files.FAQ_RAW)


@query("json_array", f"WITH {PAIRS} SELECT question, answer, length(question) < 60 AS found_duplicate FROM pairs")
def json_array(spark, sf):
    """Files that hold one JSON array each, of a bounded number of objects."""
    path = new_path(spark, "faq-array")
    turns = load(spark, sf, "conversations").count()  # no more pairs than turns
    flagged = pairs(spark, sf).select(
        F.pmod(F.xxhash64("pair_id"), F.lit(max(2, -(-turns // ARRAY_ROWS)))).alias("part"),
        "question", "answer", (F.length("question") < 60).alias("found_duplicate"),
    )
    files.write_json_array_files(flagged, path, "part")
    return files.read_json_array(spark, path, files.FAQ_RAW).select("question", "answer", "found_duplicate")


#: Least splits of the files that the two queries below read; far smaller than usual, so that every file has several.
SPLIT_BYTES = 16 * 1024
#: Larger files are cut into larger splits, about this many in all: a task for each 16 KB would cost more than its work.
SPLITS = 1000


def split_bytes(spark, path: str) -> int:
    """Length of a split by the volume of the files; their contents are not read."""
    total = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    return max(SPLIT_BYTES, total // SPLITS)


@contextmanager
def _small_splits(spark, path: str):
    names = {"spark.sql.files.maxPartitionBytes": str(split_bytes(spark, path)), "spark.sql.files.openCostInBytes": "1k"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _odd_pairs(spark, sf):
    """Pairs whose answers hold what also divides records: brackets, braces, quotes, backslashes and line breaks."""
    odd = F.concat(F.lit('}]{"\\'), F.col("answer"), F.lit('\n},{ \\"["\n,'), F.col("turn").cast("string"))
    return pairs(spark, sf).select("pair_id", "question", odd.alias("answer"), (F.length("question") < 60).alias("found_duplicate"))


ODD_PAIRS_SQL = f"""{PAIRS}, odd AS (SELECT question, '}}]{{"\\' || answer || chr(10) || '}},{{ \\"["' || chr(10) || ',' || (pair_id % 4294967296) AS answer,
  length(question) < 60 AS found_duplicate FROM pairs)"""


@query("json_array_splits", f"WITH {ODD_PAIRS_SQL} SELECT question, answer, found_duplicate FROM odd")
def json_array_splits(spark, sf):
    """Files of one JSON array each, cut anywhere and read by as many tasks as there are splits."""
    path = new_path(spark, "faq-array")
    flagged = _odd_pairs(spark, sf)
    parts = max(2, -(-load(spark, sf, "conversations").count() // ARRAY_ROWS))
    files.write_json_array_files(flagged.withColumn("part", F.pmod(F.xxhash64("pair_id"), F.lit(parts))).drop("pair_id"), path, "part")
    with _small_splits(spark, f"{path}/part=*"):
        return materialize(records.read_json_array(spark, f"{path}/part=*", files.FAQ_RAW), "array-rows")


@query("csv_splits", f"WITH {ODD_PAIRS_SQL} SELECT question, answer FROM odd")
def csv_splits(spark, sf):
    """CSV files with line breaks in texts, cut anywhere and read by as many tasks as there are splits."""
    path = new_path(spark, "faq-csv")
    files.write_csv(_odd_pairs(spark, sf).select("pair_id", "answer", "question"), path)
    with _small_splits(spark, path):
        return materialize(records.read_csv(spark, path, files.FAQ), "csv-rows")



@query("json_lines", f"WITH {PAIRS} SELECT question, answer, length(question) < 60 AS found_duplicate FROM pairs")
def json_lines(spark, sf):
    path = new_path(spark, "faq-lines")
    flagged = pairs(spark, sf).select("question", "answer", (F.length("question") < 60).alias("found_duplicate"))
    files.write_json_lines(flagged, path)
    return files.read_json_lines(spark, path, files.FAQ_RAW)


@query(
    "qa_text",
    f"""WITH {PAIRS}, texts AS (SELECT question || chr(10) || answer || chr(10) AS t FROM pairs)
        SELECT line, count(*) AS n FROM (SELECT unnest(string_split(t, chr(10))) AS line FROM texts) GROUP BY line""",
)
def qa_text(spark, sf):
    """Pairs written as question, answer and blank line; the lines read back, with how often each occurs."""
    path = new_path(spark, "faq-text")
    files.write_qa_text(pairs(spark, sf), path)
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("line"))
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query(
    "faq_pairs",
    f"WITH {PAIRS} SELECT pair_id, question AS input, answer AS output, 1.0::DOUBLE AS target FROM pairs",
)
def faq_pairs_query(spark, sf):
    return pairs(spark, sf).select(
        "pair_id", F.col("question").alias("input"), F.col("answer").alias("output"), F.lit(1.0).alias("target")
    )


@query(
    "text_combine",
    f"WITH {PAIRS} SELECT pair_id, question || ' ' || answer AS text, "
    "'user''s question: ' || question || ' description: ' || answer AS prompt FROM pairs",
)
def text_combine(spark, sf):
    return pairs(spark, sf).select(
        "pair_id",
        combine("question", "answer").alias("text"),
        F.format_string("user's question: %s description: %s", "question", "answer").alias("prompt"),
    )


@query(
    "dedup_answer",
    """SELECT doc_id, text AS answer FROM (
         SELECT d.doc_id, d.text, row_number() OVER (PARTITION BY d.text ORDER BY d.doc_id) AS rn
         FROM documents d JOIN labels l USING (doc_id) WHERE l.toxic = 0) WHERE rn = 1""",
)
def dedup_answer(spark, sf):
    flagged = labelled(spark, sf).select(
        "doc_id", F.col("text").alias("answer"), (F.col("toxic") == 1).alias("found_duplicate")
    )
    kept = flagged.filter(~F.col("found_duplicate"))
    return cleaning.first_per_key(kept, "answer", "doc_id").select("doc_id", "answer")


@query(
    "dedup_text",
    """SELECT doc_id, lang, source FROM (
         SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
)
def dedup_text(spark, sf):
    docs = load(spark, sf, "documents")
    return cleaning.first_per_key(docs, "text", "doc_id").select("doc_id", "lang", "source")


@query(
    "rare_class_filter",
    f"""WITH {LABELLED}, named AS (SELECT doc_id, '[' || array_to_string(
          list_transform(terms, lambda t: '''' || t || ''''), ', ') || ']' AS terms FROM labelled)
        SELECT doc_id, terms FROM named WHERE terms IN (SELECT terms FROM named GROUP BY terms HAVING count(*) > 1)""",
)
def rare_class_filter(spark, sf):
    return cleaning.keep_repeated_groups(printed_terms(spark, sf), "terms").select("doc_id", "terms")


def printed_terms(spark, sf):
    """The label list as the text a list prints to."""
    quoted = F.transform("terms", lambda t: F.concat(F.lit("'"), t, F.lit("'")))
    return labelled(spark, sf).select(
        "doc_id", F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")).alias("terms")
    )


@query(
    "value_counts",
    f"WITH {PAIRS}, lens AS (SELECT length(answer)::BIGINT AS answer_chars FROM pairs) "
    "SELECT answer_chars, count(*) AS n FROM lens GROUP BY ALL",
)
def value_counts(spark, sf):
    lengths = pairs(spark, sf).select(F.length("answer").cast("bigint").alias("answer_chars"))
    return cleaning.value_counts(lengths, "answer_chars")


@query(
    "value_counts_lang",
    "SELECT lang, count(*) AS n FROM documents GROUP BY lang",
)
def value_counts_lang(spark, sf):
    return cleaning.value_counts(load(spark, sf, "documents"), "lang")


@query(
    "class_balance",
    "SELECT count(lang) AS n_classes, max(n) AS max_n, min(n) AS min_n "
    "FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)",
)
def class_balance(spark, sf):
    return cleaning.class_balance(load(spark, sf, "documents"), "lang")


@query(
    "profile_numeric",
    """WITH words AS (
         SELECT 'space_words' AS measure, len(string_split(text, ' '))::BIGINT AS v FROM documents
         UNION ALL SELECT 'words', len(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda t: t <> ''))::BIGINT
         FROM documents)
       SELECT measure, count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min,
              round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50,
              round(quantile_cont(v, 0.75), 6) AS p75, max(v) AS max
       FROM words GROUP BY measure""",
)
def profile_numeric(spark, sf):
    profile = cleaning.numeric_profile(
        load(spark, sf, "documents"),
        {"space_words": space_word_count("text"), "words": F.size(whitespace_tokens("text"))},
    )
    rounded = [F.round(c, 6).alias(c) for c in ("mean", "std", "p25", "p50", "p75")]
    return profile.select("measure", "count", *rounded, F.col("min").cast("bigint").alias("min"), F.col("max").cast("bigint").alias("max"))


@query(
    "profile_continuous",
    """WITH cells AS (
         SELECT 'price' AS measure, l_extendedprice::DOUBLE AS v FROM lineitem
         UNION ALL SELECT 'net', l_extendedprice::DOUBLE * (1 - l_discount::DOUBLE) * (1 + l_tax::DOUBLE) FROM lineitem
         UNION ALL SELECT 'value', value FROM events)
       SELECT measure, count(v) AS count, round(min(v), 6) AS min, round(quantile_cont(v, 0.25), 6) AS p25,
              round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75, round(max(v), 6) AS max
       FROM cells GROUP BY measure""",
)
def profile_continuous(spark, sf):
    """Quartiles of doubles that hardly repeat, found by narrowing."""
    price = F.col("l_extendedprice").cast("double")
    net = price * (1 - F.col("l_discount").cast("double")) * (1 + F.col("l_tax").cast("double"))
    lines = load(spark, sf, "lineitem").select(
        F.explode(F.array(F.struct(F.lit("price").alias("measure"), price.alias("v")), F.struct(F.lit("net").alias("measure"), net.alias("v")))).alias("c")
    ).select("c.*")
    cells = lines.unionByName(load(spark, sf, "events").select(F.lit("value").alias("measure"), F.col("value").alias("v")))
    one = {name: F.when(F.col("measure") == name, F.col("v")) for name in ("price", "net", "value")}
    profile = cleaning.numeric_profile(cells, {}, one)
    return profile.select("measure", "count", *[F.round(c, 6).alias(c) for c in ("min", "p25", "p50", "p75", "max")])


@query(
    "profile_object",
    f"""WITH {PAIRS}, long AS (
          SELECT 'question' AS field, question AS v FROM pairs UNION ALL SELECT 'answer', answer FROM pairs),
        counts AS (SELECT field, v, count(*) AS n FROM long WHERE v IS NOT NULL GROUP BY ALL)
        SELECT field, sum(n)::BIGINT AS count, count(*) AS "unique", arg_min(v, (-n, v)) AS top, max(n) AS freq
        FROM counts GROUP BY field""",
)
def profile_object(spark, sf):
    return cleaning.object_profile(pairs(spark, sf), ["question", "answer"])


@query(
    "group_lists",
    """SELECT lang, floor(doc_id / 1000)::BIGINT AS chunk, count(*) AS n, md5(string_agg(text, chr(10) ORDER BY doc_id)) AS texts
       FROM documents GROUP BY ALL""",
)
def group_lists(spark, sf):
    lists = cleaning.grouped_lists(load(spark, sf, "documents"), "lang", "doc_id", "text")
    return lists.select(
        "lang", "chunk", F.size("items").cast("bigint").alias("n"), F.md5(F.array_join("items", "\n")).alias("texts")
    )


@query(
    "vocab_size",
    """SELECT count(DISTINCT t) AS vocabulary_size, max(n)::BIGINT AS longest FROM (
         SELECT unnest(toks) AS t, len(toks) AS n FROM (
           SELECT list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda t: t <> '') AS toks FROM documents))""",
)
def vocab_size(spark, sf):
    docs = load(spark, sf, "documents").select(whitespace_tokens("text").alias("toks"))
    tokens = docs.select(F.explode("toks").alias("t"), F.size("toks").cast("bigint").alias("n"))
    # Distinct tokens are counted in two steps, so that the second sees one row per token.
    return tokens.groupBy("t").agg(F.max("n").alias("n")).agg(
        F.count(F.lit(1)).alias("vocabulary_size"), F.max("n").alias("longest")
    )


@query(
    "topn_rows",
    f"WITH {PAIRS} SELECT pair_id, question, answer FROM pairs ORDER BY pair_id LIMIT 1000",
)
def topn_rows(spark, sf):
    return ranking.first_n(pairs(spark, sf), 1000, "pair_id").select("pair_id", "question", "answer")


@query(
    "sample_n",
    "SELECT doc_id, lang FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 100",
)
def sample_n(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "lang")
    return ranking.sample_n(docs, 100, 42, "doc_id")


@query(
    "shuffle_batches",
    """SELECT doc_id, (rk - 1) // 128 AS batch_id, (rk - 1) % 128 AS batch_pos FROM (
         SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rk FROM documents)""",
)
def shuffle_batches(spark, sf):
    return ranking.shuffled_batches(load(spark, sf, "documents").select("doc_id"), 42, "doc_id", 128)


@query(
    "unify_length",
    """SELECT doc_id, CASE WHEN 150 - len(w) > 0 THEN text || repeat('<pad>', 150 - len(w))
                          ELSE array_to_string(w[1:150], ' ') END AS unified
       FROM (SELECT doc_id, text, string_split(text, ' ') AS w FROM documents)""",
)
def unify_length_query(spark, sf):
    return load(spark, sf, "documents").select("doc_id", unify_length("text").alias("unified"))


QA_LINES = """lines AS (
  SELECT conv_id, turn, CASE role WHEN 'user' THEN 'Q: ' WHEN 'assistant' THEN 'A: ' ELSE '' END
         || replace(text, chr(10), ' ') AS line FROM conversations)"""


@query(
    "qa_extract",
    f"""WITH {QA_LINES}, marked AS (
          SELECT conv_id, turn, trim(line) AS line, lower(left(trim(line), 2)) AS mark FROM lines),
        grouped AS (
          SELECT *, max(CASE WHEN mark = 'q:' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS q FROM marked)
        SELECT conv_id, q AS turn, arg_max(line, turn) FILTER (mark = 'q:') AS question,
               arg_max(line, turn) FILTER (mark = 'a:') AS answer
        FROM grouped WHERE q IS NOT NULL AND mark IN ('q:', 'a:') GROUP BY conv_id, q
        HAVING count(*) FILTER (mark = 'a:') > 0""",
)
def qa_extract(spark, sf):
    prefix = F.when(F.col("role") == "user", "Q: ").when(F.col("role") == "assistant", "A: ").otherwise("")
    lines = load(spark, sf, "conversations").select(
        "conv_id", "turn", F.concat(prefix, F.translate("text", "\n", " ")).alias("line")
    )
    found = extract_pairs(lines, "conv_id", "turn", "line")
    return found.select("conv_id", "turn", "question", "answer")


@query(
    "distinct_sketches",
    """WITH exact AS (SELECT event_type, count(DISTINCT user_id) AS n_users, count(DISTINCT ts::DATE) AS days FROM events GROUP BY ALL
                      UNION ALL SELECT 'all', count(DISTINCT user_id), count(DISTINCT ts::DATE) FROM events)
       SELECT event_type, n_users, days, true AS within FROM exact""",
)
def distinct_sketches(spark, sf):
    """Sketches of the users by event type and day, kept as a column and united later: by type, and over all. Each estimate within
    four standard errors of the exact number."""
    events = load(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    stored = materialize(sketches.sketch(events, ["event_type", "day"], "user_id"), "user-sketches")
    by_type = sketches.unite(stored, ["event_type"], F.count_distinct("day").alias("days"))
    over_all = sketches.unite(stored, [], F.count_distinct("day").alias("days")).withColumn("event_type", F.lit("all"))
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("n_users"))
    exact = exact.unionByName(events.agg(F.count_distinct("user_id").alias("n_users")).withColumn("event_type", F.lit("all")))
    told = sketches.estimated(by_type.unionByName(over_all))
    off = F.abs(F.col("estimate") - F.col("n_users"))
    return told.join(exact, "event_type").select(
        "event_type", "n_users", "days", (off <= 4 * sketches.relative_error() * F.col("n_users") + 0.5).alias("within")
    )
