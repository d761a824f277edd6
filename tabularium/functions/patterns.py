"""A rule's pattern, from the Python dialect that rules are written in to the Java string that Spark runs.

Everything that runs a rule takes it from ``rule``: the string with its flags, how many groups the compiled pattern has, and
what a match is worth. ``faults`` says of a pattern why it cannot be run, so that one bad rule costs that rule alone.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import nonblank

#: Put before a rule's pattern: ignore case, let only \n end lines, and use Unicode classes, as the rules expect.
FLAGS = "(?idU)"
DOTALL_FLAGS = "(?idsU)"

_QUANTIFIER = re.compile(r"\{(\d*)(?:(,)(\d*))?\}")


class PatternFault(ValueError):
    """A pattern that one of the two engines rejects, or reads otherwise than the other."""


def _class_end(pattern: str, at: int) -> int:
    """Index after the character class that starts at ``at``."""
    i = at + 1
    i += pattern.startswith("^", i)
    i += pattern.startswith("]", i)
    while i < len(pattern) and pattern[i] != "]":
        i += 2 if pattern[i] == "\\" else 1
    return i + 1


def _class(text: str) -> str:
    """A character class in Java's dialect: an inner bracket and ``&&`` mean themselves."""
    inner = text[1:-1]
    head = "^" if inner.startswith("^") else ""
    inner = inner[len(head) :]
    out, i = [], 0
    while i < len(inner):
        if inner[i] == "\\":
            out.append(inner[i : i + 2])
            i += 2
            continue
        out.append("\\" + inner[i] if inner[i] in "[]&" else inner[i])
        i += 1
    return f"[{head}{''.join(out)}]"


def _pieces(pattern: str) -> tuple[list[str], int, tuple[int, int] | None]:
    """Java pieces of a pattern, its number of groups, and which pieces lie within its first group."""
    out: list[str] = []
    stack: list[bool] = []
    names: dict[str, int] = {}
    groups, first, start = 0, None, None
    i = 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            out.append(r"\z" if pattern[i : i + 2] == r"\Z" else pattern[i : i + 2])
            i += 2
        elif c == "[":
            end = _class_end(pattern, i)
            out.append(_class(pattern[i:end]))
            i = end
        elif pattern.startswith("(?#", i):
            i = pattern.index(")", i) + 1
        elif pattern.startswith("(?P=", i):
            end = pattern.index(")", i)
            out.append(rf"(?:\{names[pattern[i + 4 : end]]})")
            i = end + 1
        elif pattern.startswith("(?(", i):
            raise PatternFault("a group that hangs on another has no form in Java")
        elif c == "(":
            named = re.match(r"\(\?P<(\w+)>", pattern[i:])
            captures = bool(named) or not pattern.startswith("(?", i)
            if captures:
                groups += 1
                if named:
                    names[named.group(1)] = groups
            out.append("(")
            if captures and groups == 1:
                start = len(out)
                stack.append(True)
            else:
                stack.append(False)
            i += len(named.group(0)) if named else 1
        elif c == ")":
            if stack and stack.pop():
                first = (start, len(out))
            out.append(c)
            i += 1
        elif c == "{":
            found = _QUANTIFIER.match(pattern, i)
            if found and found.group(0) != "{}" and found.group(0) != "{,}":
                low, comma, high = found.groups()
                out.append(f"{{{low or 0}{comma or ''}{high or ''}}}")
                i = found.end()
            else:
                out.append(r"\{")
                i += 1
        else:
            out.append(c)
            i += 1
    return out, groups, first


@dataclass(frozen=True)
class Rule:
    """``java``: the string that Spark runs; ``skipped``: what a whole match looks like if its first group took no part."""

    pattern: str
    java: str
    groups: int
    skipped: str | None = None

    def found(self, text: Column) -> Column:
        return F.rlike(text, F.lit(self.java))

    def count(self, text: Column) -> Column:
        return F.regexp_count(text, F.lit(self.java))

    def wholes(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.java), F.lit(0))

    def _worth(self, whole: Column, group: Column) -> Column:
        """The first group, or the whole match where it took no part; blank values are null."""
        return F.coalesce(nonblank(group), F.when(F.rlike(whole, F.lit(self.skipped)), nonblank(whole)))

    def values(self, text: Column) -> Column:
        """The value of every match, in order; null where it is blank."""
        whole = self.wholes(text)
        if not self.groups:
            return F.transform(whole, nonblank)
        return F.zip_with(whole, F.regexp_extract_all(text, F.lit(self.java), F.lit(1)), self._worth)

    def value(self, text: Column) -> Column:
        """The value of the first match; null without one."""
        whole = F.regexp_extract(text, self.java, 0)
        worth = self._worth(whole, F.regexp_extract(text, self.java, 1)) if self.groups else nonblank(whole)
        return F.when(self.found(text), worth)


def _java_groups(java: str) -> int | None:
    """Groups of a pattern as Java compiles it; None where no driver of Spark runs."""
    context = SparkContext._active_spark_context
    if context is None or context._jvm is None:
        return None
    try:
        return context._jvm.java.util.regex.Pattern.compile(java).matcher("").groupCount()
    except Exception as error:
        raise PatternFault(f"java: {str(getattr(error, 'java_exception', error)).splitlines()[0]}") from None


@lru_cache(maxsize=100_000)
def rule(pattern: str, flags: str = DOTALL_FLAGS) -> Rule:
    """The rule of a pattern; PatternFault if either engine rejects it or they count its groups differently."""
    try:
        wanted = re.compile(pattern).groups
        pieces, groups, first = _pieces(pattern)
    except (re.error, KeyError, IndexError, ValueError, OverflowError) as error:
        raise error if isinstance(error, PatternFault) else PatternFault(f"python: {error}") from None
    java = flags + "".join(pieces)
    counted = _java_groups(java)
    if not wanted == groups == (groups if counted is None else counted):
        raise PatternFault(f"{wanted} groups in Python, {counted} in Java")
    skipped = None
    if first:
        skipped = flags + "^(?:" + "".join([*pieces[: first[0]], "(?!)", *pieces[first[1] :]]) + r")\z"
        try:
            _java_groups(skipped)
        except PatternFault:  # another group's place hangs on the first one: it always takes part
            skipped = "(?!)"
    return Rule(pattern, java, groups, skipped)


def line_rule(pattern: str) -> Rule:
    """A rule that is tried on single lines: a dot ends with the line."""
    return rule(pattern, FLAGS)


def java_pattern(pattern: str) -> str:
    return line_rule(pattern).java


def faults(pattern: str) -> str | None:
    """Why a pattern cannot be run; null if it can, on lines and on whole texts."""
    try:
        rule(pattern)
        line_rule(pattern)
    except PatternFault as error:
        return str(error)
    return None


def first_value(text: Column, patterns: list[str]) -> Column:
    """The value of the last of ``patterns`` that matches: one without a match never erases an earlier one's value."""
    return F.coalesce(*(rule(p).value(text) for p in reversed(patterns))) if patterns else F.lit(None).cast("string")


# ---- literals that a match cannot do without

#: Shorter literals are met in nearly every text.
LEAST_LITERAL = 3
_OPENS = re.compile(r"\(\?[a-zA-Z]*x[a-zA-Z]*[):]")


def literal_text(text: Column) -> Column:
    """A text as ``literals`` are searched in it: lower case, with the letters that patterns take for i, k or s as these."""
    return F.lower(F.translate(text, "\u0130\u0131\u212a\u017f", "iiks"))


def _alternatives(pattern: str) -> list[list[tuple[str, str]]] | None:
    """The branches of a pattern, each as (piece, quantifier) in order; pieces that are no single character are ''."""
    branches: list[list[tuple[str, str]]] = [[]]
    i, depth = 0, 0
    while i < len(pattern):
        c, piece = pattern[i], ""
        if c == "\\":
            piece = pattern[i + 1 : i + 2] if not pattern[i + 1 : i + 2].isalnum() else ""
            i += 2
        elif c == "[":
            i = _class_end(pattern, i)
        elif c == "(":
            i, depth = i + 1, depth + 1
            while i < len(pattern) and depth:
                if pattern[i] == "\\":
                    i += 1
                elif pattern[i] == "[":
                    i = _class_end(pattern, i) - 1
                else:
                    depth += (pattern[i] == "(") - (pattern[i] == ")")
                i += 1
        elif c == "|":
            branches.append([])
            i += 1
            continue
        else:
            piece = "" if c in ".^$" else c
            i += 1
        found = re.match(r"[*+?]|\{\d*(?:,\d*)?\}", pattern[i:])
        often = found.group(0) if found else ""
        i += len(often)
        if often and i < len(pattern) and pattern[i] in "?+":
            i += 1
        branches[-1].append((piece, often))
    return branches


@lru_cache(maxsize=100_000)
def literals(pattern: str) -> tuple[str, ...]:
    """ASCII literals of which every match holds one, in lower case; empty where none can be told. Groups are not looked into."""
    if _OPENS.search(pattern):
        return ()
    found = []
    for branch in _alternatives(pattern):
        runs, run = [], ""
        for piece, often in branch:
            once = piece.isascii() and piece != "" and often in ("", "+")
            if once:
                run += piece
            if not once or often:
                runs.append(run)
                run = ""
        best = max([*runs, run], key=len).lower()
        if len(best) < LEAST_LITERAL:
            return ()
        found.append(best)
    return tuple(found)
