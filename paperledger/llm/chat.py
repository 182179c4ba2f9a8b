r"""Chat formatting: conversations of unlike layouts become canonical turns, then one text with a loss mask.

A conversation comes as JSON. Its shape, all nested field paths without values and leaf types, is hashed; the hash selects
a declared mapping (`LAYOUTS`). Prompt and completion, instruction and output, message lists and nested dialogues so
all become arrays of (role, text). A shape that no mapping declares, or text that is no JSON, keeps its row with layout and
turns null.

The template writes one line group for each turn: `[INST] text [/INST]` for user, `<s> text </s>` for assistant,
`<<SYS>> text <</SYS>>` for system, `<<ROLE>> role <<TEXT>> text <</ROLE>>` for any other role. A control string inside
a text gets a backslash, and backslashes right before it are doubled, so that reading back is exact; marks of the template
always stand behind a blank or at a line's start. The loss mask is a list of spans of code points in the formatted text, one
for each assistant text.

Null roles and texts count as empty, a conversation without turns gives an empty text. Rows that repeat stay. A
conversation is one row: its text has to be one value in the end, so a very long one is one long row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

# The control strings of the template.
OPEN = {"user": "[INST]", "assistant": "<s>", "system": "<<SYS>>"}
CLOSE = {"user": "[/INST]", "assistant": "</s>", "system": "<</SYS>>"}
OTHER_OPEN, OTHER_TEXT, OTHER_CLOSE = "<<ROLE>>", "<<TEXT>>", "<</ROLE>>"

CONTROL = r"\[/?INST\]|</?s>|<</?(?:SYS|ROLE)>>|<<TEXT>>"
TURN = r"(?s)(?:^|(?<=\n))(\[INST\]|<s>|<<SYS>>|<<ROLE>>) (.*?) (?:\[/INST\]|</s>|<</SYS>>|<</ROLE>>)(?=\n|$(?!\n))"
TURNS = "array<struct<role:string,text:string>>"

# Spark's JSON parsers refuse strings of over 20,000,000 characters: one takes an option, the other gets them emptied.
PARSER = {"maxStringLen": str((1 << 31) - 1)}
LONG = 10_000_000


@dataclass(frozen=True)
class Layout:
    """Either `fields`, (name, role) in the order of turns, or a list of turns at `path` with role and text fields."""

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    path: tuple[str, ...] = ()
    role: str = ""
    text: str = ""
    roles: dict[str, str] = field(default_factory=dict)

    def shape(self) -> str:
        if self.fields:
            return "OBJECT<" + ", ".join(f"{n}: _" for n in sorted(n for n, _ in self.fields)) + ">"
        out = "ARRAY<OBJECT<" + ", ".join(f"{n}: _" for n in sorted((self.role, self.text))) + ">>"
        for name in reversed(self.path):
            out = f"OBJECT<{name}: {out}>"
        return out

    def turns(self, json: Column) -> Column:
        if self.fields:
            parsed = F.from_json(json, ", ".join(f"{n} string" for n, _ in self.fields), PARSER)
            return F.array(*(F.struct(F.lit(role).alias("role"), parsed[n].alias("text")) for n, role in self.fields))
        ddl = f"array<struct<{self.role}:string,{self.text}:string>>"
        for name in reversed(self.path[1:]):
            ddl = f"struct<{name}:{ddl}>"
        found = F.from_json(json, f"{self.path[0]} {ddl}", PARSER)
        for name in self.path:
            found = found[name]

        def turn(x: Column) -> Column:
            role = x[self.role]
            for theirs, ours in self.roles.items():
                role = F.when(x[self.role] == theirs, ours).otherwise(role)
            return F.struct(role.alias("role"), x[self.text].alias("text"))

        return F.transform(found, turn)


LAYOUTS = (
    Layout("prompt_completion", fields=(("prompt", "user"), ("completion", "assistant"))),
    Layout("instruction", fields=(("instruction", "user"), ("output", "assistant"))),
    Layout("system_instruction", fields=(("system", "system"), ("instruction", "user"), ("output", "assistant"))),
    Layout("messages", path=("messages",), role="role", text="content"),
    Layout("from_value", path=("conversations",), role="from", text="value", roles={"human": "user", "gpt": "assistant"}),
    Layout("dialogue", path=("data", "dialog"), role="speaker", text="utterance"),
)


def shortened(json: Column) -> Column:
    """The JSON with strings of over 10,000 characters emptied, if it is long: its shape is the same.

    Escaped backslashes and quotes are written as code points first, so that a string ends at the next quote.
    """
    plain = F.regexp_replace(F.regexp_replace(json, r"\\\\", r"\\u005c"), r'\\"', r"\\u0022")
    return F.when(F.length(json) > LONG, F.regexp_replace(plain, r'"([^"]{0,10000}+)"|"[^"]*+"', '"$1"')).otherwise(json)


def shape(json: Column) -> Column:
    """All nested field paths, in order of name, without leaf types."""
    json = shortened(json)
    return F.regexp_replace(F.schema_of_variant(F.try_parse_json(json)), r"(?<=[:<] ?)[A-Z]+(?:\(\d+, ?\d+\))?(?=[,>])|^[A-Z]+(?:\(\d+, ?\d+\))?$", "_")


def fingerprint(shape: Column) -> Column:
    return F.xxhash64(shape)


def canonical(raw: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Rows (conv_id, json) with fingerprint, layout and turns."""
    df = raw.select("conv_id", "json", shape(F.col("json")).alias("_shape"))
    df = df.withColumn("fingerprint", F.when(F.col("_shape").isNotNull(), fingerprint(F.col("_shape"))))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in layouts:
        chosen = F.col("fingerprint") == fingerprint(F.lit(layout.shape()))
        name = F.when(chosen, layout.name).otherwise(name)
        turns = F.when(chosen, layout.turns(F.col("json")).cast(TURNS)).otherwise(turns)
    blank = F.lit("")
    df = df.withColumn("layout", name).withColumn("turns", turns)
    return df.select("conv_id", "fingerprint", "layout", F.transform(
        "turns", lambda t: F.struct(F.coalesce(t["role"], blank).alias("role"), F.coalesce(t["text"], blank).alias("text"))).alias("turns"))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)(\\*+)({CONTROL})", r"$1$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)(\\*)\1\\(?={CONTROL})", "$1")


def formatted(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turns, ...) with `formatted` and `loss_spans`, array of (start, stop) in code points."""

    def known(x: Column, marks: dict[str, str], other: str) -> Column:
        out = F.lit(other)
        for role, mark in marks.items():
            out = F.when(x["role"] == role, mark).otherwise(out)
        return out

    def piece(x: Column) -> Column:
        other = F.when(x["role"].isin(*OPEN), "").otherwise(F.concat(escaped(x["role"]), F.lit(f" {OTHER_TEXT} ")))
        return F.struct(
            F.concat(known(x, OPEN, OTHER_OPEN), F.lit(" "), other).alias("before"), escaped(x["text"]).alias("body"),
            F.concat(F.lit(" "), known(x, CLOSE, OTHER_CLOSE)).alias("after"), (x["role"] == "assistant").alias("loss"),
        )

    df = conversations.withColumn("_pieces", F.transform("turns", piece))
    text = F.array_join(F.transform("_pieces", lambda p: F.concat(p["before"], p["body"], p["after"])), "\n")
    zero = F.lit(0).cast("long")
    spans = F.aggregate(
        "_pieces",
        F.struct(zero.alias("at"), F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["before"]) + F.length(p["body"]) + F.length(p["after"]) + 1).alias("at"),
            F.when(p["loss"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.length(p["before"])).alias("start"),
                (acc["at"] + F.length(p["before"]) + F.length(p["body"])).alias("stop"),
            )))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return df.withColumn("formatted", text).withColumn("loss_spans", spans).drop("_pieces")


def read_back(text: Column) -> Column:
    """The turns of a formatted text."""
    marks, bodies = F.regexp_extract_all(text, F.lit(TURN), 1), F.regexp_extract_all(text, F.lit(TURN), 2)
    middle = f" {OTHER_TEXT} "

    def turn(mark: Column, body: Column) -> Column:
        role, own = F.lit(None).cast("string"), body
        for name, m in OPEN.items():
            role = F.when(mark == m, name).otherwise(role)
        other = F.substring_index(body, middle, 1)
        own = F.when(mark == OTHER_OPEN, F.substring(body, F.length(other) + len(middle) + 1, F.length(body))).otherwise(body)
        return F.struct(F.coalesce(role, unescaped(other)).alias("role"), unescaped(own).alias("text"))

    return F.zip_with(marks, bodies, turn)


def loss_text(text: Column, spans: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescaped(
        F.substring(text, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")))), "")


def as_layouts(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as one JSON text for each conversation, in a layout that can hold it.

    Two turns, user and assistant, are a prompt and its completion or an instruction and its output; with a system turn
    before them an instruction with system. Other conversations are lists: `from_value` if all roles are known to it and
    the number of turns is odd, else `dialogue` if the first text is shorter than the last, else `messages`.
    """
    blank = F.lit("")
    turn = F.struct("turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    df = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))

    def text(i: int) -> Column:
        return F.get("t", i)["text"]

    roles = F.transform("t", lambda t: t["role"])
    pair = roles == F.array(F.lit("user"), F.lit("assistant"))
    triple = roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    known = F.forall(roles, lambda r: r.isin("user", "assistant", "system"))
    theirs = F.transform("t", lambda t: F.struct(
        F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"]).alias("from"), t["text"].alias("value")))
    json = (
        F.when(pair & (F.length(text(0)) % 2 == 0), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))))
        .when(pair, F.to_json(F.struct(text(0).alias("instruction"), text(1).alias("output"))))
        .when(triple, F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output"))))
        .when(known & (F.size("t") % 2 == 1), F.to_json(F.struct(theirs.alias("conversations"))))
        .when(F.length(text(0)) < F.length(F.element_at("t", -1)["text"]), F.to_json(F.struct(F.struct(F.transform(
            "t", lambda t: F.struct(t["role"].alias("speaker"), t["text"].alias("utterance"))).alias("dialog")).alias("data"))))
        .otherwise(F.to_json(F.struct(F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages"))))
    )
    return df.select("conv_id", json.alias("json"))


def digests(done: DataFrame) -> DataFrame:
    """Counts and digests of what is read back from `formatted` and `loss_spans`."""
    df = done.select(
        "conv_id", "layout", read_back(F.col("formatted")).alias("back"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    whole = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return df.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "layout",
    )
