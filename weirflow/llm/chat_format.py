"""Chat formatting with DataFrame functions only: records of any known layout to one training text.

A record's nested field paths are hashed to a fingerprint; the fingerprint selects a declarative layout
that says where the turns, roles and texts of such a record stand.  Canonical turns are then put
between the template's marks.  Control strings inside roles and texts are escaped reversibly, so no
text can end its own turn, and the formatted text reads back to the very turns it was made of.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

# fixed values: strings that public chat templates use as marks
CONTROLS = (
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|im_sep|>",
    "<|begin_of_text|>", "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>",
    "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|end|>",
    "<start_of_turn>", "<end_of_turn>", "<bos>", "<eos>",
)
_TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Template:
    """Marks before a turn's role, between role and text, and behind the text; what is escaped inside them.

    An escaped control string is ``escape``, its number and a semicolon; the escape character itself
    has number 0.  The marks that could be taken for another place of the text are escaped too.
    """

    open: str = "<|im_start|>"
    middle: str = "\n"
    close: str = "<|im_end|>\n"
    controls: tuple[str, ...] = CONTROLS
    escape: str = "\x10"
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        for mark in self.escaped:
            if not mark or self.escape in mark or mark[0] in "0123456789;":
                raise ValueError(f"not to be escaped: {mark!r}")
        if self.open not in self.controls:
            raise ValueError("the opening mark has to be a control string")

    @property
    def escaped(self) -> tuple[str, ...]:
        """Control strings, the longest first, so that one inside another doesn't hide it."""
        return tuple(sorted(self.controls, key=lambda c: (-len(c), c)))

    def inside(self, text: Column, *more: str) -> Column:
        """The text without any control string (or ``more``)."""
        text = F.replace(text, F.lit(self.escape), F.lit(f"{self.escape}0;"))
        for k, mark in enumerate((*self.escaped, *more), 1):
            text = F.replace(text, F.lit(mark), F.lit(f"{self.escape}{k};"))
        return text

    def outside(self, text: Column, *more: str) -> Column:
        """What ``inside`` was given."""
        for k, mark in enumerate((*self.escaped, *more), 1):
            text = F.replace(text, F.lit(f"{self.escape}{k};"), F.lit(mark))
        return F.replace(text, F.lit(f"{self.escape}0;"), F.lit(self.escape))


@dataclass(frozen=True)
class Field:
    """One turn of ``role``: the texts at the paths, those that are there and not empty after the first."""

    role: str
    paths: tuple[str, ...]

    def turns(self, record: Column) -> Column:
        first, *others = [_text(record, p) for p in self.paths]
        parts = F.array(first, *[F.when(x != "", x) for x in others])
        turn = F.struct(F.lit(self.role).alias("role"), F.array_join(parts, "\n\n").alias("text"))
        return F.when(first.isNotNull(), F.array(turn)).otherwise(_no_turns())


@dataclass(frozen=True)
class Items:
    """A turn for each element of an array of objects; ``roles`` renames roles."""

    path: str
    role: str
    text: str
    roles: Mapping[str, str] = field(default_factory=dict)

    def turns(self, record: Column) -> Column:
        def turn(x: Column) -> Column:
            role, renamed = F.coalesce(_text(x, self.role), F.lit("")), None
            for old, new in self.roles.items():
                renamed = F.when(role == old, F.lit(new)) if renamed is None else renamed.when(role == old, F.lit(new))
            role = role if renamed is None else renamed.otherwise(role)
            return F.struct(role.alias("role"), F.coalesce(_text(x, self.text), F.lit("")).alias("text"))

        return F.coalesce(F.transform(_elements(record, self.path), turn), _no_turns())


@dataclass(frozen=True)
class Pairs:
    """Two turns for each element of an array of [first, second]."""

    path: str
    roles: tuple[str, str] = ("user", "assistant")

    def turns(self, record: Column) -> Column:
        def both(x: Column) -> Column:
            return F.array(*[
                F.struct(F.lit(r).alias("role"), F.coalesce(F.try_variant_get(x, f"$[{k}]", "string"), F.lit("")).alias("text"))
                for k, r in enumerate(self.roles)])

        return F.coalesce(F.flatten(F.transform(_elements(record, self.path), both)), _no_turns())


@dataclass(frozen=True)
class Layout:
    """Records with all of ``paths`` and any of ``optional``, and where their turns come from, in order."""

    name: str
    paths: tuple[str, ...]
    optional: tuple[str, ...]
    sources: tuple[Field | Items | Pairs, ...]

    def path_sets(self) -> list[tuple[str, ...]]:
        return [tuple(sorted({*self.paths, *more})) for n in range(len(self.optional) + 1) for more in combinations(self.optional, n)]

    def turns(self, record: Column) -> Column:
        return F.concat(*[s.turns(record) for s in self.sources])


_SYSTEM = Field("system", ("system",))
_NAMES = {"human": "user", "gpt": "assistant"}
LAYOUTS = (
    Layout("messages", ("messages[].content", "messages[].role"), ("id", "messages[].name", "system"), (_SYSTEM, Items("messages", "role", "content"))),
    Layout("no messages", ("messages[]",), ("id", "system"), (_SYSTEM,)),
    Layout("from and value", ("conversations[].from", "conversations[].value"), ("id", "system"),
           (_SYSTEM, Items("conversations", "from", "value", _NAMES))),
    Layout("instruction", ("instruction", "output"), ("id", "input", "system"),
           (_SYSTEM, Field("user", ("instruction", "input")), Field("assistant", ("output",)))),
    Layout("instruction with history", ("history[][]", "instruction", "output"), ("id", "input", "system"),
           (_SYSTEM, Pairs("history"), Field("user", ("instruction", "input")), Field("assistant", ("output",)))),
    Layout("prompt and completion", ("completion", "prompt"), ("id", "system"),
           (_SYSTEM, Field("user", ("prompt",)), Field("assistant", ("completion",)))),
    Layout("prompt and response", ("prompt", "response"), ("context", "id", "system"),
           (_SYSTEM, Field("user", ("prompt", "context")), Field("assistant", ("response",)))),
    Layout("question and answer", ("answer", "question"), ("context", "id", "system"),
           (_SYSTEM, Field("user", ("question", "context")), Field("assistant", ("answer",)))),
)


def _no_turns() -> Column:
    return F.array().cast(_TURNS)


def _text(record: Column, path: str) -> Column:
    return F.try_variant_get(record, f"$.{path}", "string")


def _elements(record: Column, path: str) -> Column:
    return F.try_variant_get(record, f"$.{path}", "array<variant>")


def field_paths(record: Column) -> Column:
    """The sorted paths of a variant's scalars and empty containers, such as ``messages[].role``.

    Elements of an array share the path of the array and ``[]``.  The walk goes down one level at a
    time, as deep as the record's own schema is.
    """
    level = "array<struct<path:string,value:variant>>"

    def below(at: Column) -> Column:
        fields = F.map_entries(F.try_variant_get(at["value"], "$", "map<string,variant>"))
        dotted = lambda key: F.when(at["path"] == "", key).otherwise(F.concat(at["path"], F.lit("."), key))
        in_object = F.transform(fields, lambda kv: F.struct(dotted(kv["key"]).alias("path"), kv["value"].alias("value")))
        in_array = F.transform(F.try_variant_get(at["value"], "$", "array<variant>"), lambda x: F.struct(
            F.concat(at["path"], F.lit("[]")).alias("path"), x.alias("value")))
        return F.coalesce(in_object, in_array, F.array().cast(level))

    def step(state: Column, _: Column) -> Column:
        nested = F.transform(state["open"], lambda at: F.struct(at["path"].alias("path"), below(at).alias("inner")))
        leaves = F.transform(F.filter(nested, lambda x: F.size(x["inner"]) == 0), lambda x: x["path"])
        return F.struct(
            F.flatten(F.transform(nested, lambda x: x["inner"])).alias("open"),
            F.array_union(state["done"], leaves).alias("done"))

    start = F.struct(
        F.array(F.struct(F.lit("").alias("path"), record.alias("value"))).cast(level).alias("open"),
        F.array().cast("array<string>").alias("done"))
    depth = F.length(F.regexp_replace(F.schema_of_variant(record), "[^<]", "")) + 1
    return F.array_sort(F.aggregate(F.sequence(F.lit(1), depth), start, step, lambda s: s["done"]))


def fingerprint(record: Column) -> Column:
    """A hash of the variant's field paths."""
    return F.xxhash64(field_paths(record))


def convert(records: DataFrame, record_col: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``records`` with ``fingerprint``, ``layout`` and ``turns`` (array of role and text) in place of the JSON text.

    A record no layout fits, or that is null or no JSON, keeps its row: its layout and turns are null, so
    new layouts are found by counting fingerprints.  Null texts and roles become empty; a layout's
    optional fields may be there or not.  Other columns stay.
    """
    known = {}
    for layout in layouts:
        for paths in layout.path_sets():
            if known.setdefault(paths, layout.name) != layout.name:
                raise ValueError(f"{layout.name} and {known[paths]} have the same fields")
    named = F.create_map(*[
        x for paths, name in known.items() for x in (F.xxhash64(F.array(*[F.lit(p) for p in paths])), F.lit(name))])
    others = [c for c in records.columns if c != record_col]
    parsed = records.select(*others, F.try_parse_json(F.col(record_col)).alias("_record"))
    printed = parsed.withColumn("fingerprint", F.when(F.col("_record").isNotNull(), fingerprint(F.col("_record"))))
    chosen = printed.withColumn("layout", F.element_at(named, F.col("fingerprint")))
    turns = None
    for layout in layouts:
        is_it = F.col("layout") == layout.name
        turns = F.when(is_it, layout.turns(F.col("_record"))) if turns is None else turns.when(is_it, layout.turns(F.col("_record")))
    return chosen.withColumn("turns", turns).drop("_record")


def format_turns(
    turns: DataFrame, id_col: str = "conv_id", at_col: str = "at", role_col: str = "role", text_col: str = "text",
    template: Template = Template(),
) -> DataFrame:
    """(id, n_turns, formatted, loss_mask): one text a conversation of (id, at, role, text) rows.

    Turns stand in the order of ``at``, ties by role and text.  ``loss_mask`` holds the spans a model
    learns from, the texts of the ``learned`` roles: turn (from 0), block (where its turn begins),
    start and length, in code points from 0.  Null roles and texts count as empty; a null id is a
    conversation of its own.  Turns are escaped before they are shuffled; a conversation is one
    value, so it has to fit in a row, and nothing else is gathered.
    """
    empty = F.lit("")
    t = template
    rows = turns.select(
        F.col(id_col).alias("id"), F.col(at_col).alias("at"), F.coalesce(F.col(role_col), empty).alias("role"),
        t.inside(F.coalesce(F.col(role_col), empty), t.middle).alias("_role"), t.inside(F.coalesce(F.col(text_col), empty)).alias("_text"))
    before = len(t.open) + F.char_length("_role") + len(t.middle)
    order = Window.partitionBy("id").orderBy("at", "role", "_text")
    own = rows.withColumns({"_before": before.cast("long"), "_length": F.char_length("_text").cast("long")})
    own = own.withColumn("_all", F.col("_before") + F.col("_length") + len(t.close))
    placed = own.withColumns({
        "turn": F.row_number().over(order) - 1,
        "block": F.sum("_all").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_all")})
    turn = F.struct(
        "turn", F.concat(F.lit(t.open), F.col("_role"), F.lit(t.middle), F.col("_text"), F.lit(t.close)).alias("piece"),
        F.col("role").isin(*t.learned).alias("learned"), "block", (F.col("block") + F.col("_before")).alias("start"),
        F.col("_length").alias("length"))
    gathered = placed.groupBy("id").agg(F.count("*").alias("n_turns"), F.array_sort(F.collect_list(turn)).alias("_turns"))
    learned = F.filter("_turns", lambda x: x["learned"])
    return gathered.select(
        F.col("id").alias(id_col), "n_turns",
        F.array_join(F.transform("_turns", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(learned, lambda x: F.struct(x["turn"].alias("turn"), x["block"].alias("block"), x["start"].alias("start"), x["length"].alias("length"))).alias("loss_mask"))


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """``formatted`` with ``turns`` (array of role and text) and ``learned`` (the texts under the loss mask).

    The inverse of ``format_turns``; spans are cut from their own turn's block, so the work is in
    proportion to the text however many turns there are.
    """
    t = template
    blocks = F.expr(f"slice(_blocks, 2, size(_blocks))")
    cut = formatted.withColumn("_blocks", F.split("formatted", re.escape(t.open), -1)).withColumn("_blocks", blocks)

    def turn(block: Column) -> Column:
        role = F.substring_index(block, t.middle, 1)
        begin = F.char_length(role) + len(t.middle)
        text = F.substr(block, begin + 1, F.char_length(block) - begin - len(t.close))
        return F.struct(t.outside(role, t.middle).alias("role"), t.outside(text).alias("text"))

    def span(x: Column) -> Column:
        begin = x["start"] - x["block"] - len(t.open) + 1
        return t.outside(F.substr(F.get("_blocks", x["turn"]), begin.cast("int"), x["length"].cast("int")))

    return cut.withColumns({"turns": F.transform("_blocks", turn), "learned": F.transform("loss_mask", span)}).drop("_blocks")


def format_records(
    records: DataFrame, id_col: str, record_col: str, template: Template = Template(), layouts: Sequence[Layout] = LAYOUTS
) -> DataFrame:
    """(id, n_turns, formatted, loss_mask) for each JSON record of a known layout that has turns.

    Ids are unique; ``convert`` tells which records have no known layout.
    """
    turns = convert(records.select(id_col, record_col), record_col, layouts).select(id_col, F.posexplode("turns").alias("at", "turn"))
    return format_turns(turns.select(id_col, "at", "turn.role", "turn.text"), id_col, template=template)


def packed(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(id, record): rows of turns as JSON records, each in the most specific layout that its roles allow.

    One question and answer become a prompt and completion, with a system text an instruction; whole
    rounds an instruction with history; other conversations of the usual roles ``from`` and ``value``,
    and any others messages.  Turns are ordered by ``turn_col``, null first, ties by role and text.
    """
    empty = F.lit("")
    role, text = [F.coalesce(F.col(c).cast("string"), empty) for c in (role_col, text_col)]
    turn = F.struct(F.col(turn_col).isNotNull().alias("known"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    whole = rows.groupBy(F.col(id_col).alias("id")).agg(F.sort_array(F.collect_list(turn)).alias("t"))
    roles = F.array_join(F.transform("t", lambda x: x["role"]), ",")
    texts = F.transform("t", lambda x: x["text"])
    at = lambda k: F.get(texts, F.lit(k))
    n = F.size("t")
    rounds = F.transform(F.sequence(F.lit(0), F.floor(n / 2).cast("int") - 2), lambda k: F.array(F.get(texts, 2 * k), F.get(texts, 2 * k + 1)))
    names = {new: old for old, new in _NAMES.items()}
    named = lambda x: F.coalesce(*[F.when(x["role"] == new, F.lit(old)) for new, old in names.items()], x["role"])
    usual = F.forall("t", lambda x: x["role"].isin("system", "user", "assistant"))
    record = (
        F.when(roles == "user,assistant", F.to_json(F.struct(at(0).alias("prompt"), at(1).alias("completion"))))
        .when(roles == "system,user,assistant", F.to_json(F.struct(at(0).alias("system"), at(1).alias("instruction"), at(2).alias("output"))))
        .when(roles.rlike("^user,assistant(,user,assistant)+$"), F.to_json(F.struct(
            rounds.alias("history"), F.get(texts, n - 2).alias("instruction"), F.get(texts, n - 1).alias("output"))))
        .when(usual, F.to_json(F.struct(F.transform("t", lambda x: F.struct(named(x).alias("from"), x["text"].alias("value"))).alias("conversations"))))
        .otherwise(F.to_json(F.struct(F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages")))))
    return whole.select(F.col("id").alias(id_col), record.alias("record"))
