"""Text helpers: key extraction, bracket balance, common prefixes."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern used to pull a character key out of a line of text
# (any characters in the 8-4-4-4-12 layout of a UUID).
UUID_PATTERN = "(........-....-....-....-............)"

# Fixed bracket pairs.
OPEN_BRACKETS = "([{"
CLOSE_BRACKETS = ")]}"
_BROKEN = "!"  # accumulator value once a close bracket has no partner


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_uuid(s: Column | str, pattern: str = UUID_PATTERN) -> Column:
    """First match of ``pattern`` (group 1); empty string when none."""
    return F.regexp_extract(_c(s), pattern, 1)


def uuid_text(n: Column | str) -> Column:
    """Deterministic UUID-shaped key text derived from a value (md5 layout 8-4-4-4-12)."""
    h = F.md5(_c(n).cast("string"))
    return F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
        F.substring(h, 17, 4), F.substring(h, 21, 12),
    )


BRACKET_RUN = 64  # brackets folded one by one; longer strings are cut into runs and combined


def _run_residue(run: Column) -> Column:
    """What a short run of brackets leaves once its pairs are cancelled: closers without a partner in it, then
    openers; '!' when a pair does not match."""
    def step(acc: Column, ch: Column) -> Column:
        top = F.substring(acc, -1, 1)
        pops = ((ch == ")") & (top == "(")) | ((ch == "]") & (top == "[")) | ((ch == "}") & (top == "{"))
        return (
            F.when(acc == _BROKEN, acc)
            .when(ch.isin(*OPEN_BRACKETS), F.concat(acc, ch))
            .when(pops, acc.substr(F.lit(1), F.length(acc) - 1))
            .when(top.isin(*OPEN_BRACKETS), F.lit(_BROKEN))
            .otherwise(F.concat(acc, ch))
        )

    return F.aggregate(F.split(run, ""), F.lit(""), step)


def _parts(residue: Column) -> Column:
    closers = F.regexp_extract(residue, r"^[)\]}]*", 0)
    return F.struct((residue == _BROKEN).alias("broken"), closers.alias("closers"),
                    F.when(residue == _BROKEN, F.lit("")).otherwise(F.substr(residue, F.length(closers) + 1)).alias("openers"))


def _combined(a: Column, b: Column) -> Column:
    """The residue of two neighbours: the last openers of ``a`` meet the first closers of ``b``. Associative, so
    neighbours may be combined in any order; each costs no more than their lengths."""
    n = F.least(F.length(a["openers"]), F.length(b["closers"]))
    met = F.translate(F.reverse(F.right(a["openers"], n)), OPEN_BRACKETS, CLOSE_BRACKETS) == F.left(b["closers"], n)
    return F.struct((a["broken"] | b["broken"] | ~met).alias("broken"), F.concat(a["closers"], F.substr(b["closers"], n + 1)).alias("closers"),
                    F.concat(F.left(a["openers"], F.length(a["openers"]) - n), b["openers"]).alias("openers"))


def bracket_residue(brackets: Column) -> Column:
    """``(broken, closers, openers)`` of a string of brackets.

    Runs of ``BRACKET_RUN`` are folded one by one, and neighbours combined in rounds that halve their number, so the
    cost is about the length times the logarithm of the number of runs, however deep the nesting."""
    runs = F.transform(F.regexp_extract_all(brackets, F.lit(f".{{1,{BRACKET_RUN}}}"), F.lit(0)), lambda r: _parts(_run_residue(r)))
    nothing = F.struct(F.lit(False).alias("broken"), F.lit("").alias("closers"), F.lit("").alias("openers"))

    def halved(acc: Column, _: Column) -> Column:
        pairs = F.sequence(F.lit(0), F.floor((F.size(acc) - 1) / 2).cast("int"))
        second = lambda i: F.coalesce(F.get(acc, 2 * i + 1), nothing)
        return F.when(F.size(acc) < 2, acc).otherwise(F.transform(pairs, lambda i: _combined(F.get(acc, 2 * i), second(i))))

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.length(brackets) / BRACKET_RUN + 2)).cast("int"))
    return F.coalesce(F.get(F.aggregate(rounds, runs, halved), F.lit(0)), nothing)


def is_balanced(s: Column | str) -> Column:
    """True when every bracket closes in order; other characters are ignored; empty is balanced.

    The brackets are pulled out once. Strings without any, or with unequal numbers of
    a pair's brackets (most texts that hold some), are decided by that; only the rest is reduced.
    """
    brackets = F.regexp_replace(_c(s), r"[^()\[\]{}]+", "")
    count = lambda b, ch: F.length(b) - F.length(F.replace(b, F.lit(ch), F.lit("")))
    once = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))

    def decide(b: Column) -> Column:
        unequal = reduce(or_, [count(b, o) != count(b, c) for o, c in zip(OPEN_BRACKETS, CLOSE_BRACKETS)])
        empty = lambda r: ~r["broken"] & (r["closers"] == "") & (r["openers"] == "")
        return F.when(b == "", F.lit(True)).when(unequal, F.lit(False)).otherwise(once(bracket_residue(b), empty))

    # one-element transform: the extracted string is evaluated once
    return F.when(_c(s).isNotNull(), once(brackets, decide))


def common_prefix(a: Column | str, b: Column | str) -> Column:
    """Longest common prefix of two strings (empty when none)."""
    x, y = _c(a), _c(b)
    n = F.array_max(F.filter(F.sequence(F.lit(0), F.length(x)), lambda i: F.left(x, i) == F.left(y, i)))
    return F.left(x, n)
