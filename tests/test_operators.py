"""Small cases with results worked out by hand."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import Observation, functions as F

from textloom.functions import labels as lab, sequences as seq, text as txt
from textloom.functions.vectors import cosine, sigmoid
from textloom.operators import balance, chat, cleaning, labels as label_ops, metrics, ml, qa, splits, vocabulary as voc
from textloom.operators.sessions import MICROS, sessions
from textloom.sources import files
from textloom.sources.scratch import new_path, scratch_root


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def ids(*values):
    return F.array(*[F.lit(v).cast("bigint") for v in values])


FLAVORS = [
    (1, "Vanilla", "Sweet and creamy"), (2, "Chocolate", "Rich and dark"), (3, "Strawberry", "Fruity and fresh"),
    (4, "Vanilla", "Smooth taste"), (5, "Chocolate", "Intense cocoa"),
]


@pytest.fixture(scope="module")
def flavors(spark):
    return spark.createDataFrame(FLAVORS, "id bigint, flavor string, description string")


def test_oversample_all(flavors):
    out = balance.oversample_all(flavors, "id", "flavor")
    assert rows_of(out.groupBy("flavor").count()) == [("Chocolate", 2), ("Strawberry", 2), ("Vanilla", 2)]
    assert out.join(flavors, ["id", "flavor", "description"], "left_anti").count() == 0


def test_oversample_minority_keeps_originals(flavors):
    out = balance.oversample_minority(flavors, "id", "flavor")
    assert out.filter("draw = 0").count() == 5
    assert rows_of(out.filter("draw > 0").select("flavor", "id")) == [("Strawberry", 3)]


def test_balanced_classes_need_nothing(spark):
    single = spark.createDataFrame([(i, f"c{i}") for i in range(6)], "id bigint, flavor string")
    assert balance.oversample_minority(single, "id", "flavor").count() == 6
    assert balance.undersample(single, "id", "flavor").count() == 6


def test_smote_interpolates_and_repeats_single_rows(spark):
    rows = [(i, "a", [float(i), 0.0]) for i in range(4)] + [(10, "b", [1.0, 1.0]), (11, "b", [3.0, 1.0]), (20, "c", [7.0, 7.0])]
    df = spark.createDataFrame(rows, "id bigint, c string, v array<double>")
    made = balance.smote(df, "id", "c", "v").collect()
    assert sorted(r.c for r in made) == ["b", "b", "c", "c", "c"]
    for r in made:
        if r.c == "b":
            assert {r.base, r.neighbour} == {10, 11} and 1.0 <= r.vector[0] <= 3.0 and r.vector[1] == 1.0
        else:
            assert (r.base, r.neighbour, r.vector) == (20, 20, [7.0, 7.0])


def test_integer_encoding(spark):
    vocab = spark.createDataFrame(
        [("the", 1, 45), ("quick", 1, 182), ("brown", 1, 94), ("fox", 1, 267)], "token string, n bigint, token_id bigint"
    )
    docs = spark.createDataFrame([(1, "The quick brown fox"), (2, "The slow fox"), (3, "")], "id bigint, t string")
    tokens = voc.token_rows(docs, "id", txt.sequence_tokens("t"))
    dropped = voc.sequences(voc.tokens_to_ids(tokens, vocab), docs, "id")
    assert rows_of(dropped) == [(1, [45, 182, 94, 267]), (2, [45, 267]), (3, [])]
    kept = voc.sequences(voc.tokens_to_ids(tokens, vocab, oov_id=1, num_words=200), docs, "id")
    assert rows_of(kept) == [(1, [45, 182, 94, 1]), (2, [45, 1, 1]), (3, [])]
    back = voc.decode(dropped, vocab, "id")
    assert rows_of(back) == [(1, "the quick brown fox"), (2, "the fox"), (3, "")]
    stopped = voc.decode(dropped, vocab, "id", stop_token="brown")
    assert rows_of(stopped) == [(1, "the quick"), (2, "the fox"), (3, "")]


def test_vocabulary_order_and_reserved_ids(spark):
    docs = spark.createDataFrame([(1, "b a b c"), (2, "c b d")], "id bigint, t string")
    counts = voc.token_counts(voc.token_rows(docs, "id", txt.sequence_tokens("t")))
    full = voc.build_vocabulary(counts)
    assert [(r.token, r.token_id) for r in full.orderBy("token_id").collect()] == [("b", 1), ("c", 2), ("a", 3), ("d", 4)]
    oov = voc.build_vocabulary(counts, oov_token=voc.OOV, max_tokens=4)
    assert [(r.token, r.token_id) for r in oov.orderBy("token_id").collect()] == [("<UNK>", 1), ("b", 2), ("c", 3)]


def test_tokenizers(spark):
    line = F.lit("Hi-there,  <b>it's</b>\tOK")
    assert one(spark, txt.sequence_tokens(line)) == ["hi", "there", "b", "it's", "b", "ok"]
    assert one(spark, txt.sequence_tokens(F.lit("<start> Hi <end>"), txt.KERAS_FILTERS_KEEP_MARKERS)) == ["<start>", "hi", "<end>"]
    assert one(spark, txt.stripped_tokens(line)) == ["hithere", "bitsb", "ok"]
    assert one(spark, txt.word_tokens(F.lit("a I'd like_2 été"))) == ["like_2", "été"]
    grams = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    assert [r.v for r in grams.select(txt.with_bigrams("t").alias("v")).collect()] == [["a", "b", "c", "a b", "b c"], ["a"], []]
    assert one(spark, txt.space_word_count(F.lit("a  b"))) == 3


def test_text_shaping(spark):
    assert one(spark, txt.unify_length(F.lit("a b"), 4)) == "a b<pad><pad>"
    assert one(spark, txt.unify_length(F.lit("a b c d e"), 3)) == "a b c"
    assert one(spark, txt.wrap(F.lit("x"))) == "<start> x <end>"
    assert one(spark, txt.wrap(F.lit("x"), end=None)) == "<start> x"
    assert one(spark, txt.combine(F.lit("a"), F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(
    "length, padding, truncating, want",
    [(5, "pre", "pre", [0, 0, 1, 2, 3]), (5, "post", "pre", [1, 2, 3, 0, 0]), (2, "pre", "pre", [2, 3]), (2, "post", "post", [1, 2])],
)
def test_pad_sequence(spark, length, padding, truncating, want):
    assert one(spark, seq.pad_sequence(ids(1, 2, 3), length, padding, truncating)) == want


def test_shift(spark):
    a = ids(5, 6, 7, 0)
    assert one(spark, seq.drop_last(a)) == [5, 6, 7]
    assert one(spark, seq.drop_first(a)) == [6, 7, 0]
    assert one(spark, seq.shift_left(a)) == [6, 7, 0, 0]
    with pytest.raises(ValueError):
        seq.pad_sequence(a, 3, padding="middle")


def test_labels(spark):
    assert one(spark, lab.parse_printed_list(F.lit("['cs.LG', 'cs.CV']"))) == ["cs.LG", "cs.CV"]
    for printed, wanted in [
        (["cs.LG", "it's"], None), (["O'Neil"], None), (['say "x"', "both ' and \""], None), ([], None), ("[oops", False),
    ]:
        text = printed if wanted is False else repr(printed)
        assert one(spark, lab.parse_printed_list(F.lit(text))) == (None if wanted is False else printed)
    assert one(spark, lab.split_labels(F.lit("a, b"))) == ["a", " b"]
    assert one(spark, lab.split_labels(F.lit(None).cast("string"))) == []
    assert one(spark, lab.multi_hot(ids(0, 2), 4)) == [1, 0, 1, 0]
    assert one(spark, lab.hot_positions(lab.multi_hot(ids(0, 2), 4))) == [0, 2]
    assert one(spark, lab.label_map(F.array(F.lit("x"), F.lit("x"), F.lit("y")))) == {"x": 1, "y": 1}


def test_top_n_with_threshold(spark):
    cells = [(0, "a", 0.9), (1, "b", 0.4), (2, "c", 0.6), (3, "", 0.99), (4, "d", 0.6)]
    scored = F.array(*[F.struct(F.lit(i).alias("label_id"), F.lit(n).alias("label"), F.lit(p).alias("prob")) for i, n, p in cells])
    best = lab.top_k(scored, 4)
    assert [r.label for r in one(spark, best)] == ["", "a", "c", "d"]
    assert [r.label for r in one(spark, lab.keep_above(best, 0.5, inclusive=True))] == ["a", "c", "d"]
    assert [r.label for r in one(spark, lab.keep_above(best, 0.6))] == ["a"]


def test_label_tables_round_trip(spark):
    df = spark.createDataFrame([(1, ["b", "a"]), (2, ["a"]), (3, [])], "id bigint, terms array<string>")
    counts = label_ops.label_counts(df, "terms")
    by_name = label_ops.sorted_label_ids(counts)
    assert rows_of(by_name.select("label", "label_id")) == [("a", 0), ("b", 1)]
    hot = label_ops.hot_rows(df, label_ops.encode(df, "id", "terms", by_name), "id", by_name)
    assert rows_of(hot) == [(1, [1, 1]), (2, [1, 0]), (3, [0, 0])]
    assert rows_of(label_ops.decode(hot, "id", "hot", by_name)) == [(1, ["a", "b"]), (2, ["a"]), (3, [])]
    by_use = label_ops.frequent_label_ids(counts)
    unseen = spark.createDataFrame([(9, ["zzz", "b"])], "id bigint, terms array<string>")
    assert rows_of(label_ops.encode(unseen, "id", "terms", by_use, unknown_id=0)) == [(9, 0), (9, 2)]
    assert rows_of(label_ops.encode(unseen, "id", "terms", by_name)) == [(9, 1)]


def _scores(spark, cells):
    return spark.createDataFrame(cells, "id bigint, label_id bigint, label string, y int, p double")


def test_metrics(spark):
    s = _scores(spark, [(1, 0, "a", 1, 0.5), (1, 1, "b", 1, 0.4), (2, 0, "a", 0, 0.9), (2, 1, "b", 1, 0.8)])
    assert metrics.true_label_recall(s.filter("id = 1")).first()[0] == 0.5
    assert metrics.true_label_recall(s.filter("id > 5")).first()[0] is None
    assert metrics.binary_accuracy(s).first()[0] == 0.25
    assert tuple(metrics.micro_scores(s).first())[:3] == (1, 1, 2)
    assert metrics.categorical_accuracy(s, "id").first()[0] == 0.5
    per_label = {r.label: (r.precision, r.recall, r.f1) for r in metrics.label_scores(s).collect()}
    assert per_label == {"a": (0.0, 0.0, 0.0), "b": (1.0, 0.5, pytest.approx(2 / 3))}
    assert metrics.macro_scores(s).first().macro_f1 == pytest.approx(1 / 3)
    assert metrics.mean_squared_error(s).first()[0] == pytest.approx((0.25 + 0.36 + 0.81 + 0.04) / 4)


def test_all_close(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.25)], "id bigint, p double")
    b = spark.createDataFrame([(1, 0.5000001), (2, 0.25)], "id bigint, p double")
    assert tuple(metrics.all_close(a, b, ["id"], "p").first()) == (2, True)
    assert tuple(metrics.all_close(a, b.filter("id = 1"), ["id"], "p").first()) == (2, False)


def test_activations(spark):
    assert one(spark, sigmoid(F.lit(0.0))) == 0.5
    zero = F.array(F.lit(0.0), F.lit(0.0))
    assert one(spark, cosine(F.array(F.lit(1.0), F.lit(0.0)), zero)) is None


def test_intent_modes(spark):
    for message, found, word in [
        ("Hello there", "greet", "greet"), ("this is odd", "greet", "fallback"), ("I KNOW", "deny", "fallback"),
        ("goodbye session", "goodbye", "goodbye"), ("i'm sad", "mood_unhappy", "mood_unhappy"), ("42", "fallback", "fallback"),
    ]:
        assert one(spark, chat.intent(F.lit(message))) == found
        assert one(spark, chat.intent(F.lit(message), mode="word")) == word
    assert one(spark, chat.canned_response(F.lit("deny"))) == "No worries!"
    assert one(spark, chat.canned_response(F.lit("fallback"))) == chat.DEFAULT_RESPONSE


@pytest.mark.parametrize(
    "message, name, params, status, text",
    [
        ('/intent{"name":"create_ticket","params":{"gci_id":"ABC123"}}', "create_ticket", {"gci_id": "ABC123"}, "ok", None),
        ('/intent{"name":"other"} and more', "other", {}, "ok", "No handler for intent: other"),
        ("/intent{oops}", None, None, "invalid", "Invalid message format."),
        ("hello", None, None, "invalid", "Invalid message format."),
        ('/intent{\n"name": "create_ticket"}', None, None, "invalid", "Invalid message format."),
        ('say /intent{"name":"create_ticket"}', None, None, "invalid", "Invalid message format."),
        ("  ", None, None, "empty", "Invalid message format."),
    ],
)
def test_command(spark, message, name, params, status, text):
    parsed = one(spark, chat.command(F.lit(message)))
    assert (parsed.name, parsed.params) == (name, params)
    assert one(spark, chat.message_status(F.lit(message))) == status
    routed = one(spark, chat.route(chat.command(F.lit(message))))
    assert routed.text == text
    if name == "create_ticket":
        assert (routed.type, routed.title, routed.options) == ("card", "Cases for GCI ABC123", chat.CASE_OPTIONS)


def test_attempts_and_triage(spark):
    rows = [("t", 0, "broken"), ("t", 1, "not satisfied"), ("t", 2, "still not satisfied"), ("u", 0, "bad"), ("u", 1, "hello")]
    messages = spark.createDataFrame(rows, "conv_id string, turn bigint, text string")
    levels = chat.attempt_levels(messages)
    assert rows_of(levels.select("conv_id", "turn", "attempt_level")) == [("t", 0, 1), ("t", 1, 2), ("t", 2, 3), ("u", 0, 1), ("u", 1, 1)]
    done = {(r.conv_id, r.turn): r for r in chat.triage(levels).collect()}
    assert done["u", 0].issue_type == "more_details_needed" and done["u", 0].reply == "utter_ask_more_details"
    assert done["u", 0].resolution is None and done["u", 0].decision_log is None
    assert done["u", 1].resolution == "Escalate to Team X"
    assert done["t", 1].resolution == "Escalate to Team X (FAQ: example.com/faq)"
    assert done["t", 1].collected_data["level"] == "2" and [s.step for s in done["t", 1].decision_log] == ["disposition", "resolution"]


def test_slots(spark):
    rows = [(1, 0, "screen is blank", "report_issue"), (1, 1, "yes", "affirm"), (1, 2, "hm", "fallback"), (1, 3, "no", "deny"), (2, 0, "x", "fallback")]
    messages = spark.createDataFrame(rows, "conv_id bigint, turn bigint, text string, intent string")
    got = rows_of(chat.fill_slots(messages).select("conv_id", "turn", "description", "feedback").na.fill("-"))
    assert got == [(1, 0, "screen is blank", "-"), (1, 1, "screen is blank", "yes"), (1, 2, "screen is blank", "yes"), (1, 3, "screen is blank", "no"), (2, 0, "-", "-")]


def test_bandit(spark):
    feedback = spark.createDataFrame([("full", 1.0), ("full", 0.0), ("full", 1.0)], "option string, reward double")
    values = chat.bandit_values(feedback)
    assert rows_of(values) == [("full", pytest.approx(2 / 3), 3), ("minimal", 0.5, 0)]
    assert chat.best_option(values).first()[0] == "full"
    assert chat.best_option(chat.bandit_values(feedback.filter("reward > 5"))).first()[0] == "minimal"
    assert one(spark, chat.reward(F.lit("yesterday"))) == 0.0
    assert one(spark, chat.reward(F.lit("Yesterday"), strict=False)) == 1.0
    merged = chat.merge_maps(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("1")), F.create_map(F.lit("b"), F.lit("2")))
    assert one(spark, merged) == {"a": "1", "b": "2"}


def test_qa_pairs(spark):
    lines = ["A: lost", "Q: a", "noise", "A: b", "  a: c", "Q: d", "Q: e", "A: f"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(lines)], "doc bigint, line bigint, text string")
    for span in (2, 65_536):
        got = rows_of(qa.extract_pairs(df, "doc", "line", "text", span=span).select("line", "question", "answer"))
        assert got == [(1, "Q: a", "a: c"), (6, "Q: e", "A: f")]
    path = new_path(spark, "qa")
    files.write_qa_text(qa.extract_pairs(df, "doc", "line", "text").filter("line = 1"), path)
    assert [r.value for r in spark.read.text(path).collect()] == ["Q: a", "a: c", ""]


def test_dedup_and_profiles(spark):
    df = spark.createDataFrame([(1, "x", "['a']"), (2, "y", "['a']"), (3, "x", "['b']"), (4, None, "['a']"), (5, None, "['c']")], "id bigint, t string, terms string")
    assert rows_of(cleaning.first_per_key(df, "t", "id").select("id")) == [(1,), (2,), (4,)]
    assert rows_of(cleaning.keep_repeated_groups(df, "terms").select("id")) == [(1,), (2,), (4,)]
    assert [tuple(r) for r in cleaning.object_profile(df, ["t"]).collect()] == [("t", 3, 2, "x", 2)]
    numbers = spark.createDataFrame([(v,) for v in (1, 2, 2, 7)], "v int")
    p = cleaning.numeric_profile(numbers, {"v": F.col("v")}).first()
    assert (p["count"], p["mean"], p["min"], p["p50"], p["max"]) == (4, 3.0, 1, 2.0, 7)
    assert p["std"] == pytest.approx(2.7080128)
    lists = cleaning.grouped_lists(df.na.drop(), "t", "id", "terms", chunk=2)
    assert rows_of(lists) == [("x", 0, ["['a']"]), ("x", 1, ["['b']"]), ("y", 1, ["['a']"])]


def test_splits_are_disjoint_and_complete(spark):
    df = spark.range(1000).withColumnRenamed("id", "k").withColumn("s", F.col("k") % 3)
    sizes = dict(splits.three_way(df, "k").groupBy("split").count().collect())
    assert sum(sizes.values()) == 1000 and 750 < sizes["train"] < 850
    parts = splits.stratified(df, "k", "s")
    held = parts.filter("split <> 'train'").groupBy("s").count()
    assert rows_of(held) == [(0, 34), (1, 34), (2, 34)]
    tail = splits.tail_holdout(df, "k")
    assert rows_of(tail.groupBy("held_out").agg(F.min("k"), F.max("k"))) == [(False, 0, 799), (True, 800, 999)]


def test_sessions_gap_is_inclusive(spark):
    minutes = [("u", 1, 0), ("u", 2, 60), ("u", 3, 121), ("v", 4, 0), ("v", 5, 0), ("u", 6, 60 * 48)]
    df = spark.createDataFrame(minutes, "user_id string, event_id bigint, m bigint").selectExpr(
        "user_id", "event_id", "timestamp_ntz'2024-01-01 23:00:00' + make_dt_interval(0, 0, m, 0) AS ts"
    )
    got = sessions(df).selectExpr("user_id", f"(session_end - session_start) div {60 * MICROS} AS m", "n_events")
    assert rows_of(got) == [("u", 60, 1), ("u", 60, 1), ("u", 120, 2), ("v", 60, 2)]


def test_file_round_trips(spark):
    rows = [('say "hi", then\ngo', "a,b"), ("back\\slash", ""), ("é", "line\r\nend")]
    df = spark.createDataFrame(rows, files.FAQ)
    path = new_path(spark, "csv")
    files.write_csv(df, path)
    # An empty field reads as missing, as it does in pandas.
    back = files.read_csv(spark, path, files.FAQ, multi_line=True)
    assert rows_of(back.filter("answer is not null")) == sorted([rows[0], rows[2]])
    assert rows_of(back.filter("answer is null")) == [("back\\slash", None)]
    array_path = new_path(spark, "array")
    objects = [{"question": q, "answer": a, "found_duplicate": i == 1} for i, (q, a) in enumerate(rows)]
    spark.createDataFrame([(json.dumps(objects, indent=1),)], "value string").coalesce(1).write.text(array_path)
    back = files.read_json_array(spark, array_path, files.FAQ_RAW)
    assert rows_of(back.filter(~F.col("found_duplicate")).select("question", "answer")) == sorted([rows[0], rows[2]])
    lines = new_path(spark, "lines")
    files.write_json_lines(df, lines)
    assert rows_of(files.read_json_lines(spark, lines, files.FAQ)) == sorted(rows)


def test_csv_goes_by_the_header(spark):
    path = new_path(spark, "csv-crlf")
    lines = [("id,answer,question\r",), ("1,a1,q1\r",), ("2,a2,q2\r",)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(path)
    for multi_line in (False, True):
        got = files.read_csv(spark, path, "question string, id bigint, answer string", multi_line)
        assert rows_of(got) == [("q1", 1, "a1"), ("q2", 2, "a2")]
    with pytest.raises(ValueError, match="has no column price"):
        files.read_csv(spark, path, "price double")


def test_words_of_other_letters_are_whole_words(spark):
    for message in ("señor hié", "algo noé", "ähi"):
        assert one(spark, chat.intent(F.lit(message), mode="word")) == "fallback"


def test_any_label_and_any_number_can_be_trained(spark):
    names = ["cs.LG", "it's", "`x`", *[f"l{i}" for i in range(147)]]
    rows = [(i, f"word{i % 150} more", [names[i % 150]]) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, text string, labels array<string>").coalesce(2)
    features, models = ml.fit_multilabel(df, "text", "labels", names, width=64, max_iter=1)
    assert list(models) == names
    scored = ml.score_multilabel(features, dict(list(models.items())[:4]), df.limit(3), "id", "text")
    assert {r.label for r in scored.collect()} == set(names[:4]) and scored.count() == 12


def test_models_of_two_classes_predict_after_an_observation(spark):
    rows = [(i, "good sun" if i % 2 else "bad rain", "up" if i % 2 else "down") for i in range(20)]
    df = spark.createDataFrame(rows, "id bigint, text string, label string").withColumn("labels", F.array("label")).coalesce(2)
    seen = Observation()
    spark.range(1).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 1
    features, models = ml.fit_multilabel(df, "text", "labels", ["down", "up"], width=64, max_iter=2)
    scored = ml.score_multilabel(features, models, df, "id", "text")
    assert all((r.p > 0.5) == ((r.label == "up") == bool(r.id % 2)) for r in scored.collect())
    predicted = ml.predict(ml.fit_classifier(df, ["text"], "label", width=64, max_iter=2), df, "id")
    assert all((r.predicted == "up") == bool(r.id % 2) for r in predicted.collect())


def test_texts_are_split_once_in_a_fit(spark, monkeypatch):
    rows = [(i, ["good sun", "bad rain now", "some wind"][i % 3], f"c{i % 3}") for i in range(30)]
    df = spark.createDataFrame(rows, "id bigint, text string, label string").coalesce(2)
    plain = ml.classifier(["text"], "label", width=64, max_iter=3).fit(df)
    split, transform = [], ml.SQLTransformer.transform
    monkeypatch.setattr(ml.SQLTransformer, "transform", lambda self, rows, *a: split.append(self) or transform(self, rows, *a))
    written, materialize = [], ml.materialize
    monkeypatch.setattr(ml, "materialize", lambda rows, name: written.append(name) or materialize(rows, name))
    once = ml.fit_classifier(df, ["text"], "label", width=64, max_iter=3)
    assert len(split) == 1 and written == ["term-counts", "features"]
    a, b = plain.stages[-1].coefficientMatrix.toArray(), once.stages[-1].coefficientMatrix.toArray()
    assert abs(a - b).max() < 1e-9
    assert {r.predicted == f"c{r.id % 3}" for r in ml.predict(once, df, "id").collect()} == {True}


def test_rare_words_keep_their_vector(spark):
    df = spark.createDataFrame([(1, ["often", "often", "once"]), (2, ["often"])], "id bigint, tokens array<string>")
    model = ml.word_vectors(df, "tokens", partitions=1)
    assert {r.word for r in model.getVectors().collect()} == {"often", "once"}


def test_scratch_follows_the_session(spark):
    assert new_path(spark, "x").startswith(scratch_root(spark)) and spark.sparkContext.applicationId in new_path(spark, "x")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert scratch_root(spark) == configured.rstrip("/")


def test_saved_pipeline_predicts_the_same(spark):
    rows = [(i, "good morning sun" if i % 2 else "bad night rain", "up" if i % 2 else "down") for i in range(20)]
    df = spark.createDataFrame(rows, "id bigint, text string, label string")
    model = ml.fit_classifier(df, ["text"], "label", width=512, max_iter=5)
    again = ml.save_and_reload(model, spark)
    first, second = ml.predict(model, df, "id"), ml.predict(again, df, "id")
    assert tuple(metrics.all_close(first, second, ["id"], "p").first()) == (20, True)
    assert {(r.id % 2, r.predicted) for r in first.collect()} == {(1, "up"), (0, "down")}


def test_text_encoder_slot(spark):
    from textloom.functions.encoders import text_encoder

    def load():
        import numpy as np

        return lambda texts: np.array([[len(t), t.count(" ")] for t in texts])

    df = spark.createDataFrame([(1, "a bc"), (2, None)], "id bigint, t string")
    got = df.select("id", text_encoder(load)("t").alias("v"))
    assert rows_of(got) == [(1, [4.0, 1.0]), (2, [0.0, 0.0])]


def test_stream_goes_on_after_a_stop_and_threads_expire(spark):
    from textloom.streaming import streams

    rows = [
        ("a", 1, "broken", "2024-01-01 10:00:00"), ("a", 2, "not satisfied", "2024-01-01 10:30:00"), ("a", 3, "still not satisfied", "2024-01-01 12:00:00"),
        ("b", 1, "not satisfied", "2024-01-01 12:10:00"), ("a", 4, "hello", "2024-01-01 18:00:00"),
    ]
    df = spark.createDataFrame(rows, "conv_id string, turn bigint, text string, at string").withColumn("ts", F.to_timestamp("at")).drop("at")
    path, out = new_path(spark, "threads-in"), new_path(spark, "threads")
    df.filter("turn <= 2 AND conv_id = 'a'").coalesce(1).write.parquet(path)

    def run():
        states = streams.thread_state(streams.file_stream(spark, path, df), ts="ts")
        return streams.drain_append(states, "threads", out).select("conv_id", F.hour("start").alias("h"), "attempt_level", "last_turn")

    assert rows_of(run()) == []  # still open
    for turn in ("turn = 3", "conv_id = 'b'", "turn = 4"):
        df.filter(turn).coalesce(1).write.mode("append").parquet(path)
    # Silence of over an hour ends the first span of "a"; the restarted stream knew what came before it.
    assert rows_of(run()) == [("a", 10, 2, 2), ("a", 12, 2, 3), ("b", 12, 2, 1)]
