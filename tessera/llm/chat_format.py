"""Chat formatting by schema fingerprints (DataFrame functions only).

A record is a JSON text of any known layout: a prompt/response pair, an instruction
record, a list of role/content messages, a list of from/value turns. The *shape* of the
record (its nested field paths, leaf types dropped) is hashed; the hash selects one of
the declared :class:`Layout` mappings, and that mapping yields canonical turns
``array<struct<role, text>>``. The turns are rendered with a marked template in which
control strings of the texts are escaped reversibly, with a loss mask over the
assistant texts.

Defined results: a null or malformed record, or one whose shape no layout declares, has
``layout`` null, ``turns`` null and ``formatted`` null; a null or missing text is the empty
text; a null role is the empty role; an absent optional field makes no turn; no turns
give the empty formatted string.

Spark parses a JSON text above some size to a null variant, as if it were malformed. So the shape of a record above
``LARGE`` bytes is taken of its skeleton (its strings emptied, equal neighbours in a list merged), and its turns are
parsed with the declared types. One whose skeleton is still above ``LARGE`` raises an error, as does any text that
Spark cannot hold (2 GB).
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role:string,text:string>>"
LARGE = 8 << 20  # bytes of a record; its variant has a few times as many, its limit is 128 MiB (16 MiB in some sessions)
_KEY = 64  # characters of a field name that a skeleton keeps, more than any declared one has


@dataclass(frozen=True)
class Layout:
    """A declarative mapping from one family of record shapes to turns.

    Either ``fields``: (path, role) in turn order, each path a top-level field, those of
    ``optional`` may be absent; or ``items``: the list field, whose elements have
    ``role`` and ``text`` fields, either of which may be absent throughout.
    ``aliases`` renames roles of a list layout.
    """

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    items: str | None = None
    role: str = "role"
    text: str = "content"
    aliases: tuple[tuple[str, str], ...] = ()

    def shapes(self) -> list[str]:
        """Every shape text that this layout stands for."""
        if self.items:
            keys = sorted((self.role, self.text))
            subsets = [s for n in range(len(keys) + 1) for s in itertools.combinations(keys, n)]
            out = [f"OBJECT<{self.items}: ARRAY<OBJECT<{', '.join(s)}>>>" for s in subsets]
            return [*out, f"OBJECT<{self.items}: ARRAY>"]
        need = [p for p, _ in self.fields if p not in self.optional]
        out = []
        for n in range(len(self.optional) + 1):
            for extra in itertools.combinations(self.optional, n):
                out.append(f"OBJECT<{', '.join(sorted([*need, *extra]))}>")
        return out


LAYOUTS: tuple[Layout, ...] = (
    Layout("pair", (("system", "system"), ("prompt", "user"), ("response", "assistant")), ("system",)),
    Layout("instruction", (("instruction", "system"), ("input", "user"), ("output", "assistant")), ("input",)),
    Layout("messages", items="messages"),
    Layout("from_value", items="conversations", role="from", text="value",
           aliases=(("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))),
)


def skeleton(record: Column) -> Column:
    """A JSON text of the same shape without its texts: strings are emptied, names cut after ``_KEY``
    characters, and equal neighbours in a list of flat objects merged."""
    unit = r'(?:[^"\\]|\\u[0-9a-fA-F]{4}|\\[^u])'
    rest = r'(?:[^"\\]++|\\u[0-9a-fA-F]{4}|\\[^u])*+'
    bare = F.regexp_replace(record, rf'"(?:({unit}{{0,{_KEY}}}+){rest}(?="\s*+:)|{rest})"', '"$1"')
    return F.regexp_replace(bare, r"(\{[^{}\[\]]*+\})(?:\s*+,\s*+\1)++", "$1")


def _is_large(record: Column, large: int) -> Column:
    return F.octet_length(record) > large


def shape(record: Column, large: int = LARGE) -> Column:
    """The nested field paths of a JSON record as one text: names in order, leaf types dropped."""
    checked = lambda b: F.when(_is_large(b, LARGE), F.raise_error(F.lit("a record is too large for its shape to be read"))).otherwise(b)
    whole = F.get(F.transform(F.array(skeleton(record)), checked), F.lit(0))  # made once
    typed = F.schema_of_variant(F.try_parse_json(F.when(_is_large(record, large), whole).otherwise(record)))
    leafless = F.regexp_replace(typed, r": (?!OBJECT<|ARRAY<)[A-Z]+(\(\d+,\d+\))?", "")
    flat = F.regexp_replace(leafless, r"ARRAY<(?!OBJECT<|ARRAY<)[A-Z]+(\(\d+,\d+\))?>", "ARRAY")
    return F.regexp_replace(flat, r"OBJECT<>", "OBJECT<>")


def fingerprint(record: Column, large: int = LARGE) -> Column:
    return F.sha2(shape(record, large), 256)


def _known(layouts: Sequence[Layout]) -> Column:
    """Fingerprint -> layout name, a literal map as large as the declarations."""
    pairs = [(s, lay.name) for lay in layouts for s in lay.shapes()]
    if len({s for s, _ in pairs}) < len(pairs):
        raise ValueError("two layouts declare the same shape")
    return F.create_map(*[x for s, n in pairs for x in (F.sha2(F.lit(s), 256), F.lit(n))])


def _declared(lay: Layout) -> str:
    """The type of a record of the layout, and a field for its text if that is malformed."""
    own = f"`{lay.items}`:array<struct<`{lay.role}`:string,`{lay.text}`:string>>" if lay.items else ",".join(f"`{p}`:string" for p, _ in lay.fields)
    return f"struct<{own},`__malformed`:string>"


def _large_turns(lay: Layout, record: Column) -> Column:
    """``_turns`` without a variant. A null field and an absent one differ by the names of the skeleton."""
    typed = F.from_json(record, _declared(lay), {"columnNameOfCorruptRecord": "__malformed"})
    names = F.json_object_keys(skeleton(record))
    made = _turns(lay, None, lambda path, kind: typed[path], lambda path: F.array_contains(names, path))
    return F.when(typed["__malformed"].isNull(), made)


def _turns(lay: Layout, variant: Column | None, get=None, there=None) -> Column:
    get = get or (lambda path, kind: F.try_variant_get(variant, f"$.{path}", kind))
    there = there or (lambda path: F.try_variant_get(variant, f"$.{path}", "variant").isNotNull())
    if lay.items:
        items = get(lay.items, f"array<struct<`{lay.role}`:string,`{lay.text}`:string>>")
        names = F.create_map(*[F.lit(x) for pair in lay.aliases for x in pair]) if lay.aliases else None

        def turn(x: Column) -> Column:
            role = F.coalesce(x[lay.role], F.lit(""))
            return F.struct((F.coalesce(names[role], role) if lay.aliases else role).alias("role"),
                            F.coalesce(x[lay.text], F.lit("")).alias("text"))
        return F.transform(items, turn)
    made = []
    for path, role in lay.fields:
        value = get(path, "string")
        turn = F.struct(F.lit(role).alias("role"), F.coalesce(value, F.lit("")).alias("text"))
        here = F.array(turn)
        if path in lay.optional:
            here = F.when(there(path), here).otherwise(F.array().cast(TURNS))
        made.append(here)
    return F.concat(*made)


def canonical_turns(df: DataFrame, record: str, layouts: Sequence[Layout] = LAYOUTS, large: int = LARGE) -> DataFrame:
    """Add ``layout`` and ``turns`` for the JSON text column ``record``; one above ``large`` bytes is parsed by declared types."""
    is_large = _is_large(F.col(record), large)
    variant = F.try_parse_json(F.when(~is_large, F.col(record)))
    named = df.withColumn("layout", F.element_at(_known(layouts), fingerprint(F.col(record), large)))
    turns = F.lit(None).cast(TURNS)
    for lay in reversed(layouts):
        own = F.when(is_large, _large_turns(lay, F.col(record))).otherwise(_turns(lay, variant))
        turns = F.when(F.col("layout") == lay.name, own).otherwise(turns)
    done = named.withColumn("turns", turns.cast(TURNS))
    # A large text whose skeleton has a known shape may still be malformed.
    return done.withColumn("layout", F.when(F.col("turns").isNotNull(), F.col("layout")))


def escape(text: Column) -> Column:
    """``<``, any backslashes, ``|``: one backslash more, so no control string is left. A bijection."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """Roles end at a line feed: that, backslashes and ``<|`` are written as two-character codes."""
    out = F.replace(role, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("\n"), F.lit("\\n"))
    return F.replace(out, F.lit("<|"), F.lit("\\p"))


def unescape_role(role: Column) -> Column:
    def piece(p: Column) -> Column:
        return F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\p"), F.lit("<|"))
    return F.array_join(F.transform(F.split(role, r"\\\\"), piece), "\\")


def format_turns(df: DataFrame, learn: Sequence[str] = ("assistant",)) -> DataFrame:
    """Add ``formatted`` and ``loss_mask`` for the column ``turns``.

    ``loss_mask`` has one ``struct<turn, offset, length>`` for each turn with a role of
    ``learn``: code points of the turn's own rendering (all before ``<|im_end|>``).
    """
    head = lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))
    rendered = F.transform("turns", lambda t: F.concat(head(t), escape(t["text"]), F.lit(END + "\n")))
    mask = F.filter(
        F.transform("turns", lambda t, i: F.struct(
            i.alias("turn"), F.length(head(t)).alias("offset"), F.length(escape(t["text"])).alias("length"),
            t["role"].isin(*learn).alias("on"))),
        lambda m: m["on"])
    return df.withColumns({
        "formatted": F.array_join(rendered, ""),
        "loss_mask": F.transform(mask, lambda m: F.struct(m["turn"], m["offset"], m["length"])),
    })


def pieces(formatted: Column) -> Column:
    """The renderings of the turns, without their end marks. Texts hold no end mark: they are escaped."""
    parts = F.split(formatted, r"<\|im_end\|>\n")
    return F.slice(parts, 1, F.size(parts) - 1)


def parse_turns(formatted: Column) -> Column:
    """Canonical turns read back from a formatted string."""
    def turn(p: Column) -> Column:
        cut = F.instr(p, "\n")
        return F.struct(unescape_role(F.substring(p, F.lit(len(START) + 1), cut - len(START) - 1)).alias("role"),
                        unescape(F.substring(p, cut + 1, F.length(p))).alias("text"))
    return F.transform(pieces(formatted), turn)


def masked_texts(formatted: Column, mask: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    parts = pieces(formatted)
    return F.transform(mask, lambda m: unescape(F.substring(F.get(parts, m["turn"]), m["offset"] + 1, m["length"])))


def gather_turns(rows: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of a table with a row for each turn: ``turns`` by turn number
    (null first; ties by role, then text; repeated rows stay)."""
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    got = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("rows"))
    return got.select("conv_id", F.transform("rows", lambda r: F.struct(r["role"], r["text"])).alias("turns"))


def as_record(turns: Column) -> Column:
    """A conversation as JSON in the layout that its own roles fit: a pair (with or without
    a system text), from/value turns when all roles are system, human or gpt, else messages."""
    text = lambda i: F.get(turns, F.lit(i))["text"]
    roles = F.transform(turns, lambda t: t["role"])
    is_roles = lambda *r: roles == F.array(*map(F.lit, r))
    pair = F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response")))
    with_system = F.to_json(F.struct(text(0).alias("system"), text(1).alias("prompt"), text(2).alias("response")))
    messages = F.to_json(F.struct(F.transform(
        turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages")))
    other = F.create_map(F.lit("user"), F.lit("human"), F.lit("assistant"), F.lit("gpt"), F.lit("system"), F.lit("system"))
    shared = F.to_json(F.struct(F.transform(
        turns, lambda t: F.struct(other[t["role"]].alias("from"), t["text"].alias("value"))).alias("conversations")))
    alternating = F.forall(roles, lambda r: r.isin("user", "assistant", "system")) & (F.get(roles, F.lit(0)) == "system")
    return (F.when(is_roles("user", "assistant"), pair)
            .when(is_roles("system", "user", "assistant"), with_system)
            .when(alternating, shared).otherwise(messages))
