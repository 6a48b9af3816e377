r"""Chat formatting: schema fingerprints choose declarative mappings that turn
heterogeneous records into canonical turns; a template renders the turns.

A record is a Variant. ``schema_of_variant`` gives its structure; with the
scalar types taken out, what is left is its nested field paths, and their hash
is the record's fingerprint. A mapping names, for one layout, the paths where
the turns are. It applies to records with the fingerprint of its bare example;
any other record goes to the mapping with the most paths of those whose paths it
has, whatever else it holds. Records of a layout that no mapping describes get
null turns and are marked ``rejected`` when they are rendered.

Template: each turn is ``<s>`` role ``<sep>`` text ``</s>``. Inside roles and
texts a backslash is doubled and a control string gets a backslash after its
first character, so no control string is left and the original comes back by
dropping each backslash that is not doubled. Only DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN, SEP, CLOSE = "<s>", "<sep>", "</s>"
#: Marks of this template and of common chat templates.
CONTROL = (OPEN, SEP, CLOSE, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
TURNS = "array<struct<role:string,text:string>>"


def _scalar(record: Column, path: str) -> Column:
    """Whether the path is there and is no list or object; a JSON null is a scalar."""
    return F.coalesce(field_paths(F.try_variant_get(record, f"$.{path}", "variant")) == "", F.lit(False))


@dataclass(frozen=True)
class Messages:
    """A list of objects, one per turn."""

    path: str  # of the list, like "messages"
    role: str = "role"
    text: str = "content"
    roles: tuple[tuple[str, str], ...] = ()  # names of this layout -> canonical roles

    def example(self) -> str:
        return f"named_struct('{self.path}', array(named_struct('{self.role}', '', '{self.text}', '')))"

    def size(self) -> int:
        return 1 << 30  # a list of turns goes before scalar fields

    def holds(self, record: Column) -> Column:
        """A list of objects in which both paths are, as scalars wherever they are."""
        items = F.try_variant_get(record, f"$.{self.path}", "array<variant>")
        objects = F.forall(items, lambda x: field_paths(x).startswith("OBJECT<"))

        def all_scalar(path: str) -> Column:
            return F.exists(items, lambda x: _scalar(x, path)) & F.forall(
                items, lambda x: _scalar(x, path) | F.try_variant_get(x, f"$.{path}", "variant").isNull())
        return objects & all_scalar(self.role) & all_scalar(self.text)

    def turns(self, record: Column) -> Column:
        items = F.try_variant_get(record, f"$.{self.path}", f"array<struct<`{self.role}`:string,`{self.text}`:string>>")

        def one(x: Column) -> Column:
            role = reduce(lambda c, ab: F.when(x[self.role] == ab[0], ab[1]).otherwise(c), self.roles, x[self.role])
            return F.struct(F.coalesce(role, F.lit("")).alias("role"),
                            F.coalesce(x[self.text], F.lit("")).alias("text"))
        return F.transform(items, one)


@dataclass(frozen=True)
class Fields:
    """Scalar fields, each one turn or a part of one: (role, paths); the parts
    of a turn are joined by a blank line, empty turns are left out."""

    parts: tuple[tuple[str, tuple[str, ...]], ...]

    def example(self) -> str:
        return "named_struct(" + ", ".join(f"'{p}', ''" for _, ps in self.parts for p in ps) + ")"

    def size(self) -> int:
        return sum(len(paths) for _, paths in self.parts)

    def holds(self, record: Column) -> Column:
        return reduce(lambda a, b: a & b, [_scalar(record, p) for _, paths in self.parts for p in paths])

    def turns(self, record: Column) -> Column:
        made = []
        for role, paths in self.parts:
            got = F.array(*[F.try_variant_get(record, f"$.{p}", "string") for p in paths])
            text = F.array_join(F.filter(got, lambda x: x.isNotNull() & (x != "")), "\n\n")
            made.append(F.struct(F.lit(role).alias("role"), text.alias("text")))
        return F.filter(F.array(*made), lambda t: t["text"] != "")


#: Roles of the from/value layout. In the other layouts a role stands for itself.
ALIASES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))
MAPPINGS: tuple[Messages | Fields, ...] = (
    Messages("messages"),
    Messages("conversations", role="from", text="value", roles=ALIASES),
    Messages("turns", role="speaker", text="text"),
    Fields((("user", ("prompt",)), ("assistant", ("completion",)))),
    Fields((("user", ("prompt",)), ("assistant", ("response",)))),
    Fields((("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Fields((("user", ("instruction", "input")), ("assistant", ("output",)))),
    Fields((("user", ("instruction",)), ("assistant", ("output",)))),
    Fields((("user", ("question",)), ("assistant", ("answer",)))),
)


def field_paths(record: Column) -> Column:
    """Structure of a variant without its scalar types, such as
    ``OBJECT<messages:ARRAY<OBJECT<content:,role:>>>``."""
    schema = F.schema_of_variant(record)
    scalar = r"(?:VOID|STRING|BOOLEAN|BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DATE|TIMESTAMP(?:_NTZ)?|BINARY|DECIMAL\(\d+,\s*\d+\))(?=[,>]|$)"
    return F.regexp_replace(F.regexp_replace(schema, scalar, ""), r"\s", "")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(field_paths(record))


def canonical_turns(record: Column, mappings: tuple = MAPPINGS) -> Column:
    """array<struct<role, text>> by the first mapping whose fingerprint is the
    record's, else the largest one whose paths the record has; null where none is."""
    seen = fingerprint(record)
    out = F.lit(None).cast(TURNS)
    for m in reversed(sorted(mappings, key=lambda m: -m.size())):
        out = F.when(m.holds(record), m.turns(record)).otherwise(out)
    for m in reversed(mappings):
        out = F.when(seen == fingerprint(F.to_variant_object(F.expr(m.example()))), m.turns(record)).otherwise(out)
    return out


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda x, s: F.replace(x, F.lit(s), F.lit(s[0] + "\\" + s[1:])), CONTROL, c)


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"\\(\\?)", "$1")


def format_turns(df: DataFrame, turns: str = "turns", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Adds ``formatted`` and ``loss_spans``: (turn, start, length), in code
    points within the rendered turn, of the text that bears loss. Null or no
    turns: an empty string and no span. ``rejected`` marks null turns."""
    t = F.coalesce(F.col(turns), F.array().cast(TURNS))
    rendered = F.transform(t, lambda x: F.concat(
        F.lit(OPEN), escape(F.coalesce(x["role"], F.lit(""))), F.lit(SEP),
        escape(F.coalesce(x["text"], F.lit(""))), F.lit(CLOSE)))
    spans = F.transform(t, lambda x, i: F.struct(
        i.alias("turn"), (F.length(escape(F.coalesce(x["role"], F.lit("")))) + len(OPEN) + len(SEP)).alias("start"),
        F.length(escape(F.coalesce(x["text"], F.lit("")))).alias("length"), x["role"].alias("role")))
    spans = F.filter(spans, lambda s: s["role"].isin(*loss_roles))
    return df.withColumns({
        "formatted": F.array_join(rendered, ""),
        "rejected": F.col(turns).isNull(),
        "loss_spans": F.transform(spans, lambda s: F.struct(s["turn"], s["start"], s["length"]))})


def read_back(df: DataFrame) -> DataFrame:
    """Adds ``read_turns`` (roles and texts parsed from ``formatted``) and
    ``loss_text`` (what lies under ``loss_spans``, unescaped, in order)."""
    df = df.withColumn("pieces", F.when(F.col("formatted") == "", F.array().cast("array<string>")).otherwise(
        F.expr(f"slice(split(formatted, '{CLOSE}', -1), 1, size(split(formatted, '{CLOSE}', -1)) - 1)")))

    def parsed(p: Column) -> Column:
        at = F.instr(p, SEP)
        return F.struct(unescape(F.substring(p, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)).alias("role"),
                        unescape(F.substring(p, at + len(SEP), F.length(p))).alias("text"))
    under = F.transform("loss_spans", lambda s: unescape(
        F.substring(F.element_at(F.col("pieces"), s["turn"] + 1), s["start"] + 1, s["length"])))
    return df.withColumns({"read_turns": F.transform("pieces", parsed),
                           "loss_text": F.array_join(under, "")}).drop("pieces")


def conversation_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record): rows (conv_id, turn, role, text) gathered into one
    record each, in the layout that its shape suggests. Turns are in order of
    turn, then role and text, nulls first; repeated rows stay; null role or text
    is empty; a null conv_id is one conversation. A conversation is one output
    record, so its rows meet in one task however many they are.

    One question and its answer become fields, and so do a system text, a
    question and its answer, if no text is empty (fields without text are no
    turns); which fields, the number of characters of the question decides, as
    the sources of such records differ. Longer ones of the canonical roles alone
    become a from/value list, with that layout's names; of any other roles, a
    list of speakers if the first role is none of the canonical ones, else of
    messages.
    """
    item = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(item)).alias("items"))
    items = F.col("items")
    roles = F.transform(items, lambda x: x["role"])
    full = F.forall(items, lambda x: x["content"] != "")

    def are(*names: str) -> Column:
        return full & (roles == F.array(*[F.lit(x) for x in names]))

    def text(i: int) -> Column:
        return F.get(items, F.lit(i))["content"]

    def fields(**parts: Column) -> Column:
        return F.to_variant_object(F.struct(*[c.alias(k) for k, c in parts.items()]))

    def listed(path: str, role: str, content: str, aliases: tuple = ()) -> Column:
        def named(x: Column) -> Column:
            name = reduce(lambda c, ab: F.when(x["role"] == ab[1], ab[0]).otherwise(c), aliases, x["role"])
            return F.struct(name.alias(role), x["content"].alias(content))
        return F.to_variant_object(F.struct(F.transform(items, named).alias(path)))

    pairs = (("prompt", "completion"), ("prompt", "response"), ("instruction", "output"), ("question", "answer"))
    pair = fields(**dict(zip(pairs[0], (text(0), text(1)))))
    for k, names in enumerate(pairs[1:], 1):
        pair = F.when(F.length(text(0)) % len(pairs) == k, fields(**dict(zip(names, (text(0), text(1)))))).otherwise(pair)
    canonical = ("system", "user", "assistant")
    record = (F.when(are("user", "assistant"), pair)
              .when(are(*canonical), fields(system=text(0), prompt=text(1), response=text(2)))
              .when(F.forall(roles, lambda r: r.isin(*canonical)), listed("conversations", "from", "value", ALIASES[:2]))
              .when(~F.get(roles, F.lit(0)).isin(*canonical), listed("turns", "speaker", "text"))
              .otherwise(listed("messages", "role", "content")))
    return gathered.select("conv_id", record.alias("record"))


def format_conversations(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Digest of the formatted conversations, read back from the output."""
    turns = conversation_records(rows).withColumn("turns", canonical_turns(F.col("record")))
    out = read_back(format_turns(turns))
    all_text = F.array_join(F.transform("read_turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(all_text.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
