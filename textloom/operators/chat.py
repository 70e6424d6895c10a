"""Chat-log operators: intent, command parsing, routing, triage, slots and feedback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textloom.functions.hashing import seeded_int, seeded_uniform
from textloom.operators.ordered import blocked_window

# Intent rules in order of precedence, and the canned responses.
INTENT_RULES = {
    "greet": ["hi", "hello", "hey", "good morning", "good evening"],
    "goodbye": ["bye", "goodbye", "see you", "take care"],
    "mood_great": ["i'm happy", "feeling good", "doing great"],
    "mood_unhappy": ["i'm sad", "not feeling well", "bad mood"],
    "bot_challenge": ["are you a bot", "who made you", "are you real"],
    "affirm": ["yes", "sure", "correct", "absolutely"],
    "deny": ["no", "never", "wrong"],
    "end_session": ["end chat", "exit", "goodbye session"],
    "skills_list": ["what can you do", "help options", "show features"],
}
INTENT_RESPONSES = {
    "greet": ["Hello!", "Hey there!", "Hi, how can I assist you?"],
    "goodbye": ["Goodbye!", "See you soon!", "Take care!"],
    "mood_great": ["That's awesome!", "Glad to hear that!"],
    "mood_unhappy": ["I'm here if you need to talk.", "Hope things get better soon."],
    "bot_challenge": ["Yes, I am a bot, but I'm here to help!", "I'm an AI assistant."],
    "affirm": ["Okay!", "Sounds good!", "Alright."],
    "deny": ["No worries!", "Understood.", "Alright, let me know if you need help."],
    "end_session": ["Ending session now. Goodbye!", "Take care!"],
    "skills_list": ["I can help with ticket creation, checking case details, and more."],
}
DEFAULT_RESPONSE = "I'm not sure how to respond to that."
SMALL_TALK = [
    "That's interesting!",
    "Tell me more.",
    "I see what you mean.",
    "Can you explain further?",
    "That sounds great!",
]
CASE_OPTIONS = ["Case 1", "Case 2", "Case 3"]
TASK_HANDLERS = ["create_ticket", "get_case_details"]
INVALID_FORMAT = "Invalid message format."
NO_HANDLER = "No handler for intent: "
MIN_DESCRIPTION = 5
MORE_DETAILS = "more_details_needed"
ISSUE, DISPOSITION, RESOLUTION = "hardware_failure", "support_staff_needed", "Escalate to Team X"
FAQ_LINK = " (FAQ: example.com/faq)"
BANDIT_OPTIONS = ["minimal", "full"]
BANDIT_START = 0.5
BANDIT_EPSILON = 0.1


def intent(text: Column | str, rules: dict[str, list[str]] | None = None, mode: str = "search") -> Column:
    """First intent, in rule order, with a pattern found in the text; else ``fallback``.

    ``search`` finds patterns anywhere, as in "hi" inside "this"; ``word`` needs whole words.
    """
    rules = rules or INTENT_RULES
    text = F.col(text) if isinstance(text, str) else text
    chain: Column | None = None
    for name, patterns in rules.items():
        body = "|".join(f"(?:{p})" for p in patterns)
        regex = f"(?iu)(?:{body})" if mode == "search" else rf"(?iu)(?<![\p{{L}}\p{{N}}_])(?:{body})(?![\p{{L}}\p{{N}}_])"
        hit = text.rlike(regex)
        chain = F.when(hit, F.lit(name)) if chain is None else chain.when(hit, F.lit(name))
    return chain.otherwise("fallback") if chain is not None else F.lit("fallback")


def _choose(intent_name: Column, values: dict[str, Column], default: Column) -> Column:
    chain: Column | None = None
    for name, value in values.items():
        test = intent_name == name
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return chain.otherwise(default) if chain is not None else default


def canned_response(intent_name: Column | str) -> Column:
    """First response of the intent, or the default text."""
    name = F.col(intent_name) if isinstance(intent_name, str) else intent_name
    return _choose(
        name, {k: F.lit(v[0]) for k, v in INTENT_RESPONSES.items()}, F.lit(DEFAULT_RESPONSE)
    )


def small_talk(seed: int, key: str) -> Column:
    """One of the small-talk replies, fixed by seed and key."""
    replies = F.array(*[F.lit(r) for r in SMALL_TALK])
    return F.element_at(replies, (seeded_int(seed, key) % len(SMALL_TALK) + 1).cast("int"))


def command(text: Column | str) -> Column:
    """Parse ``/intent{json}`` at the start of a message: ``struct<name, params>``.

    Broken JSON gives null fields; a payload without params gives an empty map. The payload does
    not extend over line ends.
    """
    text = F.col(text) if isinstance(text, str) else text
    body = F.regexp_extract(text, r"^/intent(\{[^\n]*\})", 1)
    parsed = F.from_json(
        F.nullif(body, F.lit("")),
        "name string, params map<string,string>",
        {"allowSingleQuotes": "false"},
    )
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    params = F.when(parsed["name"].isNotNull(), F.coalesce(parsed["params"], empty))
    return F.struct(parsed["name"].alias("name"), params.alias("params"))


def message_status(text: Column | str) -> Column:
    """``empty``, ``invalid`` or ``ok`` for a command message."""
    body = F.col(text) if isinstance(text, str) else text
    return (
        F.when(F.coalesce(F.trim(body), F.lit("")) == "", "empty")
        .when(command(body)["name"].isNull(), "invalid")
        .otherwise("ok")
    )


def route(parsed: Column) -> Column:
    """Response ``struct<type, title, options, text>`` of a parsed command."""
    name, params = parsed["name"], parsed["params"]
    no_options = F.array().cast("array<string>")

    def reply(kind: str, title: Column, options: Column, text: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("type"), title.alias("title"), options.alias("options"), text.alias("text")
        )

    nothing = F.lit(None).cast("string")
    card = reply(
        "card",
        F.concat(F.lit("Cases for GCI "), F.coalesce(params["gci_id"], F.lit("None"))),
        F.array(*[F.lit(c) for c in CASE_OPTIONS]),
        nothing,
    )
    return (
        F.when(name.isNull(), reply("error", nothing, no_options, F.lit(INVALID_FORMAT)))
        .when(name == TASK_HANDLERS[0], card)
        .when(name == TASK_HANDLERS[1], reply("task", name, no_options, nothing))
        .otherwise(reply("error", nothing, no_options, F.concat(F.lit(NO_HANDLER), name)))
    )


def attempt_levels(
    messages: DataFrame,
    thread: str = "conv_id",
    order: str = "turn",
    text: str = "text",
    phrases: tuple[str, ...] = ("not satisfied",),
) -> DataFrame:
    """Adds ``attempt_level``: 1 + messages of the thread so far that voice dissatisfaction."""
    voiced = F.lit(False)
    for phrase in phrases:
        voiced = voiced | F.lower(text).contains(phrase)
    out = blocked_window(messages, [thread], order, sums={"_voiced": voiced.cast("bigint")})
    return out.withColumn("attempt_level", F.col("_voiced") + 1).drop("_voiced")


def merge_maps(left: Column, right: Column) -> Column:
    """Union of two maps where the right one wins."""
    rest = F.map_filter(left, lambda k, v: ~F.map_contains_key(right, k))
    return F.map_concat(rest, right)


def choose_option(best: Column, seed: int, *key: str) -> Column:
    """Epsilon-greedy option: mostly ``best``, sometimes a hash-picked one."""
    options = F.array(*[F.lit(o) for o in BANDIT_OPTIONS])
    picked = F.element_at(options, (seeded_int(f"{seed}-pick", *key) % len(BANDIT_OPTIONS) + 1).cast("int"))
    return F.when(seeded_uniform(seed, *key) < BANDIT_EPSILON, picked).otherwise(best)


def triage(messages: DataFrame, text: str = "text", level: str = "attempt_level", seed: int = 42, keys: tuple[str, ...] = ("conv_id", "turn"), best: Column | None = None) -> DataFrame:
    """Issue, disposition, collected data, decision log, resolution and reply kind per message.

    The constant issue, disposition and resolution stand in for scored model columns. ``best`` is the option that feedback has
    shown to be best so far, as the bandit's table gives it; without feedback it is the first.
    """
    best = F.lit(BANDIT_OPTIONS[0]) if best is None else best
    unclear = F.length(text) < MIN_DESCRIPTION
    first = choose_option(best, seed, *keys)
    second = choose_option(best, seed + 1, *keys)

    def data(**items: str | Column) -> Column:
        cells: list[Column] = []
        for k, v in items.items():
            cells += [F.lit(k), F.lit(v) if isinstance(v, str) else v]
        return F.create_map(*cells)

    def step(name: str, choice: str) -> Column:
        return F.array(F.struct(F.lit(name).alias("step"), F.col(choice).alias("choice")))

    level_text = F.col(level).cast("string")
    base = F.when(F.col("_first") == "minimal", data(user_id="123")).otherwise(
        data(user_id="123", device_info="printer_model_X")
    )
    added = F.when(F.col("_second") == "minimal", data(priority="high", level=level_text)).otherwise(
        data(priority="high", team_status="available", level=level_text)
    )
    link = F.when(F.col(level) > 1, FAQ_LINK).otherwise("")
    clear = messages.withColumn("_first", first).withColumn("_second", second).withColumn("_clear", ~unclear)
    return (
        clear.withColumn("issue_type", F.when(F.col("_clear"), ISSUE).otherwise(MORE_DETAILS))
        .withColumn("disposition", F.when(F.col("_clear"), DISPOSITION))
        .withColumn("collected_data", F.when(F.col("_clear"), merge_maps(base, added)))
        .withColumn(
            "decision_log",
            F.when(
                F.col("_clear"), F.concat(step("disposition", "_first"), step("resolution", "_second"))
            ),
        )
        .withColumn("resolution", F.when(F.col("_clear"), F.concat(F.lit(RESOLUTION), link)))
        .withColumn(
            "reply",
            F.when(F.col("issue_type") == MORE_DETAILS, "utter_ask_more_details")
            .when(F.col("resolution").isNotNull(), "utter_present_resolution")
            .when(F.col("disposition").isNotNull(), "utter_present_disposition"),
        )
        .drop("_first", "_second", "_clear")
    )


def fill_slots(
    messages: DataFrame,
    intent_col: str = "intent",
    thread: str = "conv_id",
    order: str = "turn",
    text: str = "text",
    describing: tuple[str, ...] = ("report_issue", "provide_details"),
) -> DataFrame:
    """Latest ``description`` and ``feedback`` slot of the thread after every message."""
    name = F.col(intent_col)
    feedback = F.when(name == "affirm", "yes").when(name == "deny", "no")
    description = F.when(name.isin(*describing), F.col(text))
    return blocked_window(
        messages, [thread], order, lasts={"description": description, "feedback": feedback}
    )


def reward(feedback: Column | str, strict: bool = True) -> Column:
    """1.0 for a yes; non-strict accepts any text containing "yes"."""
    said = F.lower(feedback)
    liked = said == "yes" if strict else said.contains("yes")
    return F.when(F.coalesce(liked, F.lit(False)), 1.0).otherwise(0.0)


def last_decisions(log: DataFrame, thread: str, order: str, choice: Column) -> DataFrame:
    """Adds ``last_choice``: the latest decision of the thread up to each row."""
    return blocked_window(log, [thread], order, lasts={"last_choice": choice})


def bandit_values(feedback: DataFrame, option: str = "option", reward_col: str = "reward") -> DataFrame:
    """Mean reward and count per option; an option without feedback keeps the start value."""
    spark = feedback.sparkSession
    options = spark.createDataFrame([(o,) for o in BANDIT_OPTIONS], "option string")
    seen = feedback.groupBy(F.col(option).alias("option")).agg(
        F.avg(reward_col).alias("value"), F.count(reward_col).alias("n")
    )
    # One row per option on both sides.
    return options.join(seen, "option", "left").select(
        "option",
        F.coalesce("value", F.lit(BANDIT_START)).alias("value"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def best_option(values: DataFrame) -> DataFrame:
    """One row: the option with the highest value, the first listed on ties."""
    place = F.array_position(F.array(*[F.lit(o) for o in BANDIT_OPTIONS]), F.col("option"))
    return values.agg(F.max_by("option", F.struct("value", (-place).alias("neg"))).alias("best"))
