"""Chat logs in batch and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions.hashing import seeded_int
from textloom.operators import chat, rules
from textloom.operators.sessions import micros, sessions
from textloom.plans.registry import HASH, HASH_RANGE, query, sql_text
from textloom.sources.scratch import new_path
from textloom.sources.tables import load
from textloom.streaming import streams, threads

# The chat tables hold invented prose: these words of it stand in for "not satisfied".
VOICED = ("not satisfied", "nicht", " la ")
# What no rule matches counts as a description of the issue.
DESCRIBING = ("fallback",)


def _intent_sql(text: str, mode: str = "search") -> str:
    arms = []
    for name, patterns in chat.INTENT_RULES.items():
        body = "|".join(patterns)
        if mode == "word":
            body = rf"(^|[^\p{{L}}\p{{N}}_])({body})($|[^\p{{L}}\p{{N}}_])"
        arms.append(f"WHEN regexp_matches({text}, {sql_text(body)}, 'i') THEN {sql_text(name)}")
    return f"CASE {' '.join(arms)} ELSE 'fallback' END"


RESPONSE_SQL = (
    "CASE intent "
    + " ".join(f"WHEN {sql_text(k)} THEN {sql_text(v[0])}" for k, v in chat.INTENT_RESPONSES.items())
    + f" ELSE {sql_text(chat.DEFAULT_RESPONSE)} END"
)


@query(
    "intent_regex",
    f"SELECT conv_id, turn, {_intent_sql('text')} AS found, {_intent_sql('text', 'word')} AS word FROM conversations",
)
def intent_regex(spark, sf):
    return load(spark, sf, "conversations").select(
        "conv_id", "turn", chat.intent("text").alias("found"), chat.intent("text", mode="word").alias("word")
    )


# Command messages of every kind, made from the events: with and without parameters, broken
# JSON, plain text, empty, and a payload broken over lines.
def _commands(spark, sf):
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.concat(F.lit('/intent{"name": "create_ticket", "params": {"gci_id": "'), "event_id", F.lit('"}}')))
        .when(kind == "click", F.lit('/intent{"name": "get_case_details"}'))
        .when(kind == "error", F.concat(F.lit("/intent{oops "), "props", F.lit("}")))
        .when(kind == "signup", F.concat(F.lit('/intent{"name": "signup", "params": '), "props", F.lit("}")))
        .when(F.col("event_id") % 3 == 0, F.lit(" "))
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit("buy "), "props"))
        .otherwise(F.lit('/intent{\n"name": "create_ticket"}'))
    )
    return load(spark, sf, "events").select("event_id", text.alias("text"))


COMMANDS = """commands AS (SELECT event_id, CASE event_type
   WHEN 'view' THEN '/intent{"name": "create_ticket", "params": {"gci_id": "' || event_id || '"}}'
   WHEN 'click' THEN '/intent{"name": "get_case_details"}'
   WHEN 'error' THEN '/intent{oops ' || props || '}'
   WHEN 'signup' THEN '/intent{"name": "signup", "params": ' || props || '}'
   ELSE CASE event_id % 3 WHEN 0 THEN ' ' WHEN 1 THEN 'buy ' || props
        ELSE '/intent{' || chr(10) || '"name": "create_ticket"}' END END AS text FROM events),
 bodies AS (SELECT *, regexp_extract(text, '^/intent(\\{[^\\n]*\\})', 1) AS body FROM commands),
 parsed AS (SELECT event_id, text, CASE WHEN json_valid(body) THEN json_extract_string(body, '$.name') END AS name,
                   CASE WHEN json_valid(body) THEN json_extract_string(body, '$.params.gci_id') END AS gci_id,
                   CASE WHEN json_valid(body) THEN json_extract_string(body, '$.params.k') END AS k FROM bodies)"""


@query(
    "intent_command",
    f"""WITH {COMMANDS} SELECT event_id, CASE WHEN trim(text) = '' THEN 'empty' WHEN name IS NULL THEN 'invalid' ELSE 'ok' END AS status,
          name, gci_id, k FROM parsed""",
)
def intent_command(spark, sf):
    rows = _commands(spark, sf).withColumn("c", chat.command("text"))
    return rows.select(
        "event_id", chat.message_status("text").alias("status"), F.col("c.name").alias("name"),
        F.col("c.params")["gci_id"].alias("gci_id"), F.col("c.params")["k"].alias("k"),
    )


@query(
    "intent_route",
    f"""WITH {COMMANDS} SELECT event_id,
          CASE WHEN name = 'create_ticket' THEN 'card' WHEN name = 'get_case_details' THEN 'task' ELSE 'error' END AS type,
          CASE WHEN name = 'create_ticket' THEN 'Cases for GCI ' || coalesce(gci_id, 'None')
               WHEN name = 'get_case_details' THEN name END AS title,
          CASE WHEN name = 'create_ticket' THEN 'Case 1|Case 2|Case 3' ELSE '' END AS options,
          CASE WHEN name IS NULL THEN 'Invalid message format.'
               WHEN name NOT IN ('create_ticket', 'get_case_details') THEN 'No handler for intent: ' || name END AS text
        FROM parsed""",
)
def intent_route(spark, sf):
    routed = _commands(spark, sf).select("event_id", chat.route(chat.command("text")).alias("r"))
    return routed.select(
        "event_id", "r.type", "r.title", F.array_join("r.options", "|").alias("options"), "r.text"
    )


@query(
    "intent_response",
    f"WITH i AS (SELECT conv_id, turn, {_intent_sql('text')} AS intent FROM conversations) "
    f"SELECT conv_id, turn, intent, {RESPONSE_SQL} AS response FROM i",
)
def intent_response(spark, sf):
    return streams.classify_stream(load(spark, sf, "conversations")).select(
        "conv_id", "turn", "intent", "response"
    )


@query(
    "response_pick",
    f"""SELECT event_id, [{', '.join(sql_text(r) for r in chat.SMALL_TALK)}][({HASH.format("'42:' || event_id")} % 5)::INT + 1] AS response
        FROM events""",
)
def response_pick(spark, sf):
    return load(spark, sf, "events").select("event_id", chat.small_talk(42, "event_id").alias("response"))


VOICED_SQL = "(" + " OR ".join(f"contains(lower(text), {sql_text(p)})" for p in VOICED) + ")"
ATTEMPTS = f"""levels AS (SELECT *, (1 + sum({VOICED_SQL}::INT) OVER (PARTITION BY conv_id ORDER BY turn))::BIGINT AS attempt_level
   FROM conversations)"""


@query("ticket_attempts", f"WITH {ATTEMPTS} SELECT conv_id, turn, attempt_level FROM levels")
def ticket_attempts(spark, sf):
    messages = load(spark, sf, "conversations").select("conv_id", "turn", "text")
    return chat.attempt_levels(messages, phrases=VOICED).select("conv_id", "turn", "attempt_level")


def _choice_sql(seed: int, best: str = "'minimal'") -> str:
    key = "':' || source || ':' || doc_id"
    picked = HASH.format(f"'{seed}-pick' || {key}")
    return (
        f"CASE WHEN {HASH.format(f'{sql_text(str(seed))} || {key}')} / {HASH_RANGE}::DOUBLE < 0.1 "
        f"THEN ['minimal', 'full'][({picked} % 2)::INT + 1] ELSE {best} END"
    )


TRIAGE_SQL = f"""CASE WHEN length(text) < 5 THEN 'more_details_needed' ELSE 'hardware_failure' END AS issue_type,
          CASE WHEN length(text) >= 5 THEN 'support_staff_needed' END AS disposition,
          CASE WHEN length(text) >= 5 THEN 'Escalate to Team X' || CASE WHEN attempt_level > 1 THEN ' (FAQ: example.com/faq)' ELSE '' END END AS resolution,
          CASE WHEN length(text) >= 5 THEN CASE WHEN c1 = 'full' THEN 'device_info=printer_model_X,' ELSE '' END || 'level=' || attempt_level
               || ',priority=high' || CASE WHEN c2 = 'full' THEN ',team_status=available' ELSE '' END || ',user_id=123' ELSE '' END AS collected,
          CASE WHEN length(text) >= 5 THEN 'disposition=' || c1 || ',resolution=' || c2 ELSE '' END AS decisions,
          CASE WHEN length(text) < 5 THEN 'utter_ask_more_details' ELSE 'utter_present_resolution' END AS reply"""
TICKETS_SQL = f"""tickets AS (SELECT source, doc_id, text, {_choice_sql(42)} AS c1, {_choice_sql(43)} AS c2,
          (1 + sum({VOICED_SQL}::INT) OVER (PARTITION BY source ORDER BY doc_id))::BIGINT AS attempt_level FROM documents)"""


def _triaged(spark, sf, best=None):
    tickets = load(spark, sf, "documents").select("source", "doc_id", "text")
    levels = chat.attempt_levels(tickets, "source", "doc_id", phrases=VOICED)
    done = chat.triage(levels, keys=("source", "doc_id"), best=best)

    def show(entries, key, value):
        return F.array_join(F.transform(entries, lambda e: F.concat(e[key], F.lit("="), e[value])), ",")

    return done.select(
        "source", "doc_id", "issue_type", "disposition", "resolution",
        F.coalesce(show(F.array_sort(F.map_entries("collected_data")), "key", "value"), F.lit("")).alias("collected"),
        F.coalesce(show(F.col("decision_log"), "step", "choice"), F.lit("")).alias("decisions"),
        "reply",
    )


@query("ticket_triage", f"WITH {TICKETS_SQL} SELECT source, doc_id, {TRIAGE_SQL} FROM tickets")
def ticket_triage(spark, sf):
    """Documents as tickets, one thread per source: some texts are too short to act on."""
    return _triaged(spark, sf)


@query(
    "slot_fill",
    f"""WITH i AS (SELECT conv_id, turn, text, {_intent_sql('text')} AS intent FROM conversations)
        SELECT conv_id, turn, intent,
          arg_max(CASE WHEN intent = 'fallback' THEN text END, CASE WHEN intent = 'fallback' THEN turn END) OVER w AS description,
          arg_max(CASE intent WHEN 'affirm' THEN 'yes' WHEN 'deny' THEN 'no' END,
                  CASE WHEN intent IN ('affirm', 'deny') THEN turn END) OVER w AS feedback
        FROM i WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""",
)
def slot_fill(spark, sf):
    messages = load(spark, sf, "conversations").select("conv_id", "turn", "text", chat.intent("text").alias("intent"))
    return chat.fill_slots(messages, describing=DESCRIBING).select("conv_id", "turn", "intent", "description", "feedback")


# Views and clicks are decisions (parity of k is the option), purchases and errors the feedback on
# the user's latest decision.
LOG_SQL = """log AS (SELECT event_id, user_id, event_type,
    CASE WHEN event_type IN ('view', 'click') THEN
      CASE WHEN json_extract_string(props, '$.k')::INT % 2 = 0 THEN 'minimal' ELSE 'full' END END AS choice,
    CASE event_type WHEN 'purchase' THEN 'yes' WHEN 'error' THEN 'no' END AS feedback FROM events),
 decided AS (SELECT *, arg_max(choice, CASE WHEN choice IS NOT NULL THEN event_id END)
               OVER (PARTITION BY user_id ORDER BY event_id) AS option FROM log),
 stats AS (SELECT option, avg((feedback = 'yes')::INT) AS value, count(*) AS n FROM decided
           WHERE feedback IS NOT NULL AND option IS NOT NULL GROUP BY option),
 vals AS (SELECT o.option, coalesce(value, 0.5) AS value, coalesce(n, 0) AS n
            FROM (SELECT unnest(['minimal', 'full']) AS option) o LEFT JOIN stats USING (option))"""


def _option(props="props"):
    k = F.get_json_object(props, "$.k").cast("int")
    return F.when(k % 2 == 0, "minimal").otherwise("full")


def _bandit(spark, sf):
    kind = F.col("event_type")
    log = load(spark, sf, "events").select(
        "event_id", "user_id",
        F.when(kind.isin("view", "click"), _option()).alias("choice"),
        F.when(kind == "purchase", "yes").when(kind == "error", "no").alias("feedback"),
    )
    decided = chat.last_decisions(log, "user_id", "event_id", F.col("choice"))
    answered = decided.filter(F.col("feedback").isNotNull() & F.col("last_choice").isNotNull())
    return chat.bandit_values(
        answered.select(F.col("last_choice").alias("option"), chat.reward("feedback").alias("reward"))
    )


@query("bandit_values", f"WITH {LOG_SQL} SELECT option, round(value, 6) AS value, n FROM vals")
def bandit_values(spark, sf):
    return _bandit(spark, sf).withColumn("value", F.round("value", 6))


@query(
    "bandit_choice",
    f"""WITH {LOG_SQL}, best AS (SELECT option FROM vals ORDER BY value DESC, option = 'full' LIMIT 1)
        SELECT event_id, CASE WHEN {HASH.format("'42:' || event_id")} / {HASH_RANGE}::DOUBLE < 0.1
          THEN ['minimal', 'full'][({HASH.format("'42-pick:' || event_id")} % 2)::INT + 1]
          ELSE (SELECT option FROM best) END AS option FROM events""",
)
def bandit_choice(spark, sf):
    best = chat.best_option(_bandit(spark, sf)).scalar()
    events = load(spark, sf, "events").select("event_id").withColumn("best", best)
    return events.select("event_id", chat.choose_option(F.col("best"), 42, "event_id").alias("option"))


@query(
    "ticket_triage_learnt",
    f"""WITH {LOG_SQL}, best AS (SELECT option FROM vals ORDER BY value DESC, option = 'full' LIMIT 1),
        {TICKETS_SQL.replace(_choice_sql(42), _choice_sql(42, "(SELECT option FROM best)")).replace(_choice_sql(43), _choice_sql(43, "(SELECT option FROM best)"))}
        SELECT source, doc_id, {TRIAGE_SQL} FROM tickets""",
)
def ticket_triage_learnt(spark, sf):
    """As ``ticket_triage``, with the option that the feedback so far has shown to be best."""
    return _triaged(spark, sf, chat.best_option(_bandit(spark, sf)).scalar())


SESSIONS_SQL = """ev AS (SELECT user_id, epoch_us(ts) AS t FROM events),
 gaps AS (SELECT *, coalesce(t - lag(t) OVER (PARTITION BY user_id ORDER BY t) > 3600000000, true)::INT AS opens FROM ev),
 numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY t) AS no FROM gaps),
 sess AS (SELECT user_id, min(t) AS session_start, max(t) + 3600000000 AS session_end, count(*) AS n_events
          FROM numbered GROUP BY user_id, no)"""


@query("sessions", f"WITH {SESSIONS_SQL} SELECT * FROM sess")
def sessions_query(spark, sf):
    return sessions(load(spark, sf, "events"))


@query(
    "stream_intent",
    f"WITH i AS (SELECT conv_id, turn, {_intent_sql('text')} AS intent FROM conversations) "
    f"SELECT conv_id, turn, intent, {RESPONSE_SQL} AS response FROM i",
)
def stream_intent(spark, sf):
    arriving = streams.table_stream(spark, sf, "conversations")
    answered = streams.classify_stream(arriving).select("conv_id", "turn", "intent", "response")
    return streams.drain_append(answered, "stream-intent")


@query(
    "stream_bandit",
    """SELECT CASE WHEN json_extract_string(props, '$.k')::INT % 2 = 0 THEN 'minimal' ELSE 'full' END AS option,
         round(avg((event_type = 'purchase')::INT), 6) AS value, count(*) AS n FROM events GROUP BY ALL""",
)
def stream_bandit(spark, sf):
    events = streams.table_stream(spark, sf, "events")
    feedback = events.select(
        _option().alias("option"),
        chat.reward(F.when(F.col("event_type") == "purchase", "yes").otherwise("no")).alias("reward"),
    )
    values = streams.running_rewards(feedback, "option", "reward")
    return streams.drain_complete(values, "stream-bandit").withColumn("value", F.round("value", 6))


@query(
    "stream_sessions",
    f"WITH {SESSIONS_SQL} SELECT * FROM sess WHERE session_end <= (SELECT max(t) - 600000000 FROM ev)",
)
def stream_sessions(spark, sf):
    """Sessions closed by the watermark once all events are in."""
    events = load(spark, sf, "events").withColumn("_at", F.unix_micros(F.col("ts").cast("timestamp")))
    arriving = streams.file_stream(spark, streams.arrivals(events, "_at", "events-in"), events)
    closed = streams.drain_append(streams.session_stream(arriving), "stream-sessions")
    return closed.select(
        "user_id", micros("session_start").alias("session_start"), micros("session_end").alias("session_end"), "n_events"
    )


@query(
    "stream_attempts",
    f"""WITH i AS (SELECT *, {_intent_sql('text')} AS intent FROM conversations)
        SELECT conv_id, 1 + count(*) FILTER ({VOICED_SQL}) AS attempt_level,
          arg_max(text, turn) FILTER (intent = 'fallback') AS description,
          arg_max(CASE intent WHEN 'affirm' THEN 'yes' ELSE 'no' END, turn) FILTER (intent IN ('affirm', 'deny')) AS feedback,
          max(turn) AS last_turn FROM i GROUP BY conv_id""",
)
def stream_attempts(spark, sf):
    messages = load(spark, sf, "conversations")
    arriving = streams.file_stream(spark, streams.arrivals(messages, "turn", "turns-in"), messages)
    state = streams.thread_state(arriving, phrases=VOICED, describing=DESCRIBING)
    return streams.drain_update(state, ["conv_id"], "stream-attempts")


@query("stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def stream_dedup(spark, sf):
    """Every event delivered twice, in two micro-batches, kept once."""
    events = load(spark, sf, "events").withColumn("_at", F.unix_micros(F.col("ts").cast("timestamp")))
    arriving = streams.file_stream(spark, streams.arrivals(events, "_at", "events-twice", late_copies=True), events)
    once = streams.dedup_stream(arriving, "event_id")
    return streams.drain_append(once.select("event_id", "user_id", "event_type"), "stream-dedup")


# Turns get a time of arrival: a thread starts within two days, a turn follows 20 minutes after the one before, give or take.
ARRIVED_SQL = f"""timed AS (
   SELECT conv_id, turn, text, {_intent_sql('text')} AS intent,
     1704067200000000 + 1000000 * ({HASH.format("'start:' || conv_id")} % 172800 + turn * 1200 + {HASH.format("'turn:' || conv_id || ':' || turn")} % 5400) AS at_us
   FROM conversations),
 gaps AS (SELECT *, (coalesce(at_us - lag(at_us) OVER w > 3600000000, true))::INT AS opens FROM timed WINDOW w AS (PARTITION BY conv_id ORDER BY at_us, turn)),
 numbered AS (SELECT *, sum(opens) OVER (PARTITION BY conv_id ORDER BY at_us, turn) AS session FROM gaps),
 spans AS (
   SELECT conv_id, session::BIGINT AS session, min(at_us) AS start_us, max(at_us) AS end_us, count(*) AS messages,
     1 + count(*) FILTER ({VOICED_SQL}) AS attempt_level,
     arg_max(text, (at_us, turn)) FILTER (intent = 'fallback') AS own_description,
     arg_max(CASE intent WHEN 'affirm' THEN 'yes' ELSE 'no' END, (at_us, turn)) FILTER (intent IN ('affirm', 'deny')) AS own_feedback
   FROM numbered GROUP BY conv_id, session)"""


def _arrived(spark, sf):
    seconds = seeded_int("start", "conv_id") % 172800 + F.col("turn") * 1200 + seeded_int("turn", "conv_id", "turn") % 5400
    return load(spark, sf, "conversations").withColumn("at_us", F.lit(1704067200000000) + 1000000 * seconds)


@query(
    "stream_thread_expiry",
    f"""WITH {ARRIVED_SQL}
        SELECT conv_id, session, start_us, end_us, messages, attempt_level,
          last_value(own_description IGNORE NULLS) OVER w AS description, last_value(own_feedback IGNORE NULLS) OVER w AS feedback
        FROM spans WINDOW w AS (PARTITION BY conv_id ORDER BY session ROWS UNBOUNDED PRECEDING)
        QUALIFY end_us + 3600000000 < (SELECT max(at_us) // 1000 * 1000 - 600000000 FROM timed)""",
)
def stream_thread_expiry(spark, sf):
    """Sessions of threads, closed by an hour of silence: the level starts anew, slots are carried over. The stream is stopped after half of the messages and goes on from its checkpoint."""
    messages = _arrived(spark, sf)
    arriving = streams.Arrivals(messages, "at_us", "threads-in")
    out = new_path(spark, "thread-sessions")
    with threads.rocksdb(spark):
        for parts in (2, None):
            stream = streams.file_stream(spark, arriving.deliver(parts), messages).withColumn("ts", F.timestamp_micros("at_us"))
            told = threads.signals(stream, phrases=VOICED, describing=DESCRIBING)
            closed = streams.drain_append(threads.thread_sessions(told), "thread-sessions", out)
    return closed


@query(
    "intent_rules_table",
    f"SELECT conv_id, turn, {_intent_sql('text')} AS found, {_intent_sql('text', 'word')} AS word FROM conversations",
)
def intent_rules_table(spark, sf):
    """As ``intent_regex``, with the rules as a table and one automaton for all of them."""
    table = rules.rules_table(spark, chat.INTENT_RULES)
    found = rules.classify(load(spark, sf, "conversations").select("conv_id", "turn", "text"), table, out="found")
    return rules.classify(found, table, out="word", mode="word").select("conv_id", "turn", "found", "word")


# A rule that is put before all others while the stream runs.
LATE_RULE = ("foreign", " la ")


@query(
    "stream_intent_rules",
    f"""SELECT conv_id, turn, CASE WHEN turn > 1 AND contains(lower(text), {sql_text(LATE_RULE[1])}) THEN {sql_text(LATE_RULE[0])}
          ELSE {_intent_sql('text')} END AS intent FROM conversations""",
)
def stream_intent_rules(spark, sf):
    """Messages as they arrive, by the rules as they are then: a rule is added to the table between two micro-batches."""
    messages = load(spark, sf, "conversations").select("conv_id", "turn", "text")
    arriving, table, out = new_path(spark, "rule-turns"), new_path(spark, "rules"), new_path(spark, "ruled")
    rules.rules_table(spark, chat.INTENT_RULES).write.parquet(table)
    for early in (True, False):
        if not early:
            spark.createDataFrame([(-1, *LATE_RULE)], "place long, intent string, pattern string").write.mode("append").parquet(table)
        messages.filter(F.col("turn") <= 1 if early else F.col("turn") > 1).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(messages.schema).parquet(arriving)
        ruled = rules.drain_classified(stream, lambda: spark.read.parquet(table), "ruled", out)
    return ruled.select("conv_id", "turn", "intent")
