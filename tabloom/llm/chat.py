"""Chat records of many layouts to one template, chosen by a fingerprint of their fields.

The shape of a JSON record is the tree of its nested field paths, with every
scalar written as ``*``.  Its hash selects a ``Layout``, a declarative list of
paths and the roles they hold, which turns the record into canonical turns.  The
shape comes from Spark's variant type; no schema is given and no Python runs.

Template: ``<|turn|>role`` newline, text, ``<|end|>`` newline, per turn.  Texts
may hold control strings of this or other templates.  A backslash after the
opening character of each control string breaks it; one that already has
backslashes there gets one more, so that taking one away restores any text.
Roles are percent-encoded.  The loss mask is the list of ranges (code points of
the formatted text) that hold assistant texts; nothing of the template is in it.

Edge cases: a null text is an empty one and a null role an empty one; an empty
list of messages gives no turns and an empty formatted text; a record that is
null, no JSON, or of an unknown shape has null turns, layout and formatted text;
what follows a complete record is ignored;
texts of any length are kept whole (a record above ``LARGE`` bytes takes its shape
from a skeleton without its texts, since a variant bounds both a text and a
record); repeated rows are formatted alike; other columns stay untouched.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings that texts must not contain unbroken.
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]")
TURN, END = "<|turn|>", "<|end|>\n"
_TAILS = r"(?=\||/?s>|/?INST\])"
ASSISTANT = "assistant"
TURNS = "array<struct<role:string,text:string>>"
NO_TURNS = "[]"
#: Records above this size do not pass through a variant, which holds texts of 20 million characters and 128 MiB.
LARGE = 16_000_000
LONGEST = {"maxStringLen": str((1 << 31) - 1)}


@dataclass(frozen=True)
class Layout:
    """``fields``: (path, role) per turn, in order.  ``items``: path of a list with the paths of role and text."""

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    items: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()
    #: Extra scalar paths of an item or record that are allowed and ignored.
    ignored: tuple[str, ...] = ()

    def shapes(self) -> list[str]:
        """Every shape that this layout accepts."""
        if self.items:
            listed, role, text = self.items
            paths = [f"{listed}[].{role}", f"{listed}[].{text}"]
            return [_shape([*paths, *extra]) for extra in _subsets(self.ignored)] + [_shape([f"{listed}[]"])]
        needed = [path for path, _ in self.fields if path not in self.optional]
        return [_shape([*needed, *extra]) for extra in _subsets((*self.optional, *self.ignored))]


LAYOUTS = (
    Layout("messages", items=("messages", "role", "content"), ignored=("messages[].name", "id", "source")),
    Layout(
        "conversations",
        items=("conversations", "from", "value"),
        roles=(("human", "user"), ("gpt", ASSISTANT)),
        ignored=("id", "source"),
    ),
    Layout(
        "prompt_response",
        fields=(("system", "system"), ("prompt", "user"), ("response", ASSISTANT)),
        optional=("system",),
        ignored=("id", "source"),
    ),
    Layout(
        "prompt_completion",
        fields=(("system", "system"), ("prompt", "user"), ("completion", ASSISTANT)),
        optional=("system",),
        ignored=("id", "source"),
    ),
    Layout(
        "instruction",
        fields=(("system", "system"), ("instruction", "user"), ("input", "user"), ("output", ASSISTANT)),
        optional=("system", "input"),
        ignored=("id", "source"),
    ),
    Layout("question_answer", fields=(("question", "user"), ("answer.text", ASSISTANT)), ignored=("id", "source")),
)


def _subsets(values: tuple[str, ...]):
    return [subset for size in range(len(values) + 1) for subset in combinations(values, size)]


def _shape(paths: list[str]) -> str:
    """The shape of a record with these nested paths; ``[]`` marks a list."""
    tree: dict = {}
    for path in paths:
        node = tree
        for part in path.replace("[]", ".[]").split("."):
            node = node.setdefault(part, {})

    def written(node: dict) -> str:
        if not node:
            return "*"
        if "[]" in node:
            return f"ARRAY<{written(node['[]'])}>"
        return "OBJECT<" + ", ".join(f"{name}: {written(node[name])}" for name in sorted(node)) + ">"

    return written(tree)


def shape(record: Column) -> Column:
    """The shape of a variant."""
    scalars = r"\b(?:STRING|BIGINT|DOUBLE|FLOAT|BOOLEAN|VOID|DECIMAL\([0-9,]+\))(?=[,>]|$)"
    return F.regexp_replace(F.schema_of_variant(record), scalars, "*")


def fingerprint(record: Column) -> Column:
    """The hash of a variant's nested field paths."""
    return F.sha2(shape(record), 256)


def _role(layout: Layout, role: Column) -> Column:
    for given, canonical in layout.roles:
        role = F.when(role == given, F.lit(canonical)).otherwise(role)
    return F.coalesce(role, F.lit(""))


def _turns(layout: Layout, record: Column) -> Column:
    """Canonical turns of a variant that has this layout's shape."""
    if layout.items:
        listed, role, text = layout.items
        kind = f"array<struct<`{role}`:string,`{text}`:string>>"
        rows = F.try_variant_get(record, f"$.{listed}", kind)
        return F.transform(
            F.coalesce(rows, F.from_json(F.lit(NO_TURNS), kind)),
            lambda x: F.struct(_role(layout, x[role]).alias("role"), F.coalesce(x[text], F.lit("")).alias("text")),
        )
    turns = []
    for path, role in layout.fields:
        text = F.try_variant_get(record, f"$.{path}", "string")
        turn = F.struct(F.lit(role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
        present = F.try_variant_get(record, f"$.{path}", "variant").isNotNull() if path in layout.optional else F.lit(True)
        turns.append(F.when(present, turn))
    return F.filter(F.array(*turns), lambda x: x.isNotNull())


def skeleton(record: Column) -> Column:
    """JSON text with all strings but the names of fields emptied."""
    # Escaped backslashes and quotes become tabs (no name of a layout has one), so every quote left is a border.
    plain = F.replace(F.replace(record, F.lit("\\\\"), F.lit("\\t")), F.lit('\\"'), F.lit("\\t"))
    pieces = F.split(plain, '"', -1)
    following = F.concat(F.slice(pieces, F.lit(2), F.size(pieces)), F.array(F.lit("")))
    kept = F.zip_with(
        F.transform(pieces, lambda piece, at: F.struct(piece.alias("text"), at.alias("at"))),
        following,
        lambda piece, after: F.when((piece["at"] % 2 == 0) | after.rlike(r"^\s*:"), piece["text"]).otherwise(""),
    )
    return F.array_join(kept, '"')


def _large_turns(layout: Layout, record: Column, shaped: Column) -> Column:
    """Canonical turns of JSON text whose skeleton (a variant) has this layout's shape."""
    if layout.items:
        listed, role, text = layout.items
        kind = f"struct<`{listed}`:array<struct<`{role}`:string,`{text}`:string>>>"
        return F.transform(
            F.from_json(record, kind, LONGEST)[listed],
            lambda x: F.struct(_role(layout, x[role]).alias("role"), F.coalesce(x[text], F.lit("")).alias("text")),
        )
    turns = []
    for path, role in layout.fields:
        name, *inner = path.split(".")
        kind = "string" if not inner else f"struct<`{inner[0]}`:string>"
        value = F.from_json(record, f"struct<`{name}`:{kind}>", LONGEST)[name]
        text = value[inner[0]] if inner else value
        turn = F.struct(F.lit(role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
        present = F.try_variant_get(shaped, f"$.{path}", "variant").isNotNull() if path in layout.optional else F.lit(True)
        turns.append(F.when(present, turn))
    return F.filter(F.array(*turns), lambda x: x.isNotNull())


def _broken(record: Column) -> Column:
    """Whether a text is no JSON; read to its end, and of any length."""
    options = LONGEST | {"columnNameOfCorruptRecord": "__broken"}
    return F.from_json(record, "struct<__none:string,__broken:string>", options)["__broken"].isNotNull()


def canonical(df: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds ``layout`` and ``turns`` for a column of JSON text."""
    known = {hashlib.sha256(s.encode()).hexdigest(): layout.name for layout in layouts for s in layout.shapes()}
    names = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    large = F.octet_length(F.col(record)) > LARGE
    # A skeleton has lost what breaks a text, so the whole text is judged.
    shown = F.when(large, F.when(~_broken(F.col(record)), skeleton(F.col(record)))).otherwise(F.col(record))
    parsed = df.withColumn("__record", F.try_parse_json(shown))
    named = parsed.withColumn("layout", F.element_at(names, fingerprint(F.col("__record"))))
    turns = F.lit(None).cast(TURNS)
    for layout in layouts:
        small = _turns(layout, F.col("__record")).cast(TURNS)
        found = F.when(large, _large_turns(layout, F.col(record), F.col("__record")).cast(TURNS)).otherwise(small)
        turns = F.when(F.col("layout") == layout.name, found).otherwise(turns)
    return named.withColumn("turns", turns).drop("__record")


def escape(text: Column) -> Column:
    """Break every control string."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + _TAILS, r"$1\\$2")


def unescape(text: Column) -> Column:
    """Undo ``escape``."""
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _TAILS, "$1$2")


def format_turns(df: DataFrame, turns: str = "turns") -> DataFrame:
    """Adds ``formatted`` and ``loss``, the ranges of assistant texts in it."""
    parts = F.transform(
        F.col(turns),
        lambda t: F.struct(
            (t["role"] == ASSISTANT).alias("taught"),
            F.concat(F.lit(TURN), F.url_encode(t["role"]), F.lit("\n")).alias("head"),
            escape(t["text"]).alias("body"),
        ),
    )
    ranges = "array<struct<start:int,end:int>>"

    def step(seen: Column, part: Column) -> Column:
        start = seen["at"] + F.length(part["head"])
        end = start + F.length(part["body"])
        span = F.struct(start.alias("start"), end.alias("end"))
        found = F.when(part["taught"], F.array_append(seen["found"], span)).otherwise(seen["found"])
        return F.struct((end + len(END)).alias("at"), found.alias("found"))

    none = F.from_json(F.lit(NO_TURNS), ranges)
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))
    written = F.array_join(F.transform("__parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    return (
        df.withColumn("__parts", parts)
        .withColumn("formatted", F.when(F.col(turns).isNotNull(), written))
        .withColumn("loss", F.aggregate("__parts", start, step, lambda seen: seen["found"]))
        .drop("__parts")
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text."""
    pieces = F.split(formatted, r"<\|end\|>\n", -1)
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def read(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        role = F.url_decode(F.substr(head, F.lit(len(TURN) + 1)))
        text = F.substr(piece, F.length(head) + 2)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(turns, read)


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, in order."""
    texts = F.transform(loss, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["end"] - s["start"])))
    return F.array_join(texts, "")


def turns_text(turns: Column) -> Column:
    """role, newline, text, newline per turn."""
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")


def records_of_rows(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One JSON record per conversation from rows by turn; ties of turn by role, then text.

    A conversation becomes one text, so its turns must meet; conversations, not
    rows, are the unit that is spread over tasks.  Two or three turns of the
    usual roles take the prompt layout, all others the list of messages.
    """
    one = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("content"),
    )
    grouped = rows.select(F.col(conversation).alias(conversation), one.alias("one")).groupBy(conversation).agg(
        F.array_sort(F.collect_list("one")).alias("rows")
    )
    row = F.col("rows")
    roles = F.transform(row, lambda r: r["role"])
    prompt = F.to_json(F.struct(row[0]["content"].alias("prompt"), F.get(row, F.lit(1))["content"].alias("response")))
    system = F.to_json(
        F.struct(
            row[0]["content"].alias("system"), F.get(row, F.lit(1))["content"].alias("prompt"),
            F.get(row, F.lit(2))["content"].alias("response"),
        )
    )
    messages = F.to_json(F.struct(F.transform(row, lambda r: F.struct(r["role"], r["content"])).alias("messages")))
    usual = F.array(F.lit("user"), F.lit(ASSISTANT))
    record = (
        F.when(roles == usual, prompt)
        .when(roles == F.array(F.lit("system"), F.lit("user"), F.lit(ASSISTANT)), system)
        .otherwise(messages)
    )
    return grouped.select(conversation, record.alias("record"))
