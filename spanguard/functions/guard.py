"""The guard's columns: pattern flags, threshold zones, override, rationale, score normalization."""

from __future__ import annotations

import re._parser as P

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .text import let


def category_pattern(category: str) -> str:
    """One alternation for a category, so a text is searched once."""
    return "(?iuU)" + "|".join(f"(?:{p})" for p in V.GUARD_PATTERNS[category])


def required(pattern: str):
    """What every match of a pattern holds: ("and", parts), ("or", parts), a literal, or a run (characters, length), in lower case.

    Read off the pattern's parsed form: runs of characters, branches, and what is repeated once at least. ("and", []) says nothing.
    Literals of one or two characters tell little and are left out.
    """

    def of(items) -> tuple:
        parts, run = [], ""
        for op, arg in [*items, (None, None)]:
            if op is P.LITERAL:
                run += chr(arg)
                continue
            if len(run) > 2 or '"' in run:
                parts.append(run.lower())
            run = ""
            if op is P.SUBPATTERN:
                parts.append(of(arg[-1]))
            elif op is P.BRANCH:
                branches = [of(branch) for branch in arg[1]]
                parts.append(("and", []) if ("and", []) in branches else ("or", branches))
            elif op in (P.MAX_REPEAT, P.MIN_REPEAT) and arg[0] > 0:
                inner = list(arg[2])
                if len(inner) == 1 and inner[0][0] is P.IN and all(o in (P.LITERAL, P.RANGE) for o, _ in inner[0][1]) and arg[0] > 2:
                    held = {chr(c) for o, v in inner[0][1] for c in ([v] if o is P.LITERAL else range(v[0], v[1] + 1))}
                    parts.append(("run", "".join(sorted({c.lower() for c in held})), arg[0]))
                else:
                    parts.append(of(inner))
        return ("and", [p for p in parts if p != ("and", [])])

    return of(P.parse(pattern))


def may_match(folded: Column, need) -> Column:
    """Whether a text, in folded case, has what a pattern requires."""
    if isinstance(need, str):
        return F.contains(folded, F.lit(need))
    if need[0] == "run":
        held = "".join(f"\\x{{{ord(c):x}}}" for c in need[1])
        return (F.length(folded) >= need[2]) & folded.rlike(f"(?<![{held}])[{held}]{{{need[2]}}}")
    kind, parts = need
    if not parts:
        return F.lit(True)
    # longer literals are rarer, and decide first
    first, *rest = [may_match(folded, p) for p in sorted(parts, key=lambda p: -len(p) if isinstance(p, str) else 0)]
    for e in rest:
        first = first & e if kind == "and" else first | e
    return first


#: Characters that are equal, where case is ignored, to a Latin or Cyrillic letter that lower case doesn't make of them.
_ALIKE = "\u0130\u0131\u017f\u212a\u1c80\u1c81\u1c82\u1c83\u1c84\u1c85\u1c86"
_LETTERS = "iiskвдосттъ"


def folded_case(text: Column) -> Column:
    """Lower case as patterns that ignore case see it: what is equal to a Latin or Cyrillic letter there is that letter here."""
    return F.when(text.rlike(f"[{_ALIKE}]"), F.lower(F.translate(text, _ALIKE, _LETTERS))).otherwise(F.lower(text))


def flags(text: Column) -> Column:
    """The categories of which a pattern occurs, in their order.

    Only texts that hold what some pattern of a category requires are searched for its patterns.
    """

    def found(f: Column, patterns: list[str]) -> Column:
        """Patterns whose requirement is a literal are searched together, others by themselves."""
        out, needs = None, [(p, required(p)) for p in patterns]
        plain = [(p, n) for p, n in needs if "run" not in str(n)]
        for group in [plain, *([x] for x in needs if x not in plain)]:
            may = may_match(f, ("or", [n for _, n in group]))
            hit = may & text.rlike("(?iuU)" + "|".join(f"(?:{p})" for p, _ in group))
            out = hit if out is None else out | hit
        return out

    each = lambda f: F.array(*[F.when(found(f, patterns), F.lit(c)) for c, patterns in V.GUARD_PATTERNS.items()])
    return F.coalesce(F.array_compact(let(folded_case(text), each)), F.array().cast("array<string>"))


def zone(p1: Column, low=V.T_LOW, high=V.T_HIGH) -> Column:
    return F.when(p1 < low, V.PASS).when(p1 >= high, V.BLOCK).otherwise(V.REVIEW)


def decision(p1: Column, found: Column, low=V.T_LOW, high=V.T_HIGH) -> Column:
    """Struct assigned_class, decision, needs_review; flags turn a pass into a review."""
    z = zone(p1, low, high)
    over = (F.size(found) > 0) & (z == V.PASS)
    by_score = F.when(z == V.PASS, V.SAFE).when(z == V.BLOCK, V.INJECTION).otherwise(F.when(p1 >= 0.5, V.INJECTION).otherwise(V.SAFE))
    return F.struct(
        F.when(over, V.INJECTION).otherwise(by_score).alias("assigned_class"),
        F.when(over, V.REVIEW).otherwise(z).alias("decision"),
        (over | (z == V.REVIEW)).alias("needs_review"),
    )


def rationale(p1: Column, found: Column, decided: Column) -> Column:
    names = F.create_map(*[F.lit(x) for kv in V.CATEGORY_TEXTS.items() for x in kv])
    told = F.array_join(F.transform(found, lambda f: F.coalesce(names[f], f)), ", ")
    p = F.format_number(p1, 2)  # rounds halves to even, as the score's text is meant
    return (
        F.when(F.size(found) > 0, F.concat(F.lit(V.FLAGS_TEXT), told))
        .when(decided["assigned_class"] == V.INJECTION, F.concat(F.lit(V.CONFIDENCE_TEXT), p))
        .when(decided["needs_review"], F.concat(F.lit(V.BORDER_TEXT), p, F.lit(")")))
        .otherwise("")
    )


def normalized_score(scores: Column) -> Column:
    """p1 of a map of class scores, whichever of the known names its keys have."""
    first = lambda *names: F.coalesce(*[scores[n] for n in names], F.lit(0.0))
    bad, good = first("INJECTION", "LABEL_1", "1"), first("SAFE", "LABEL_0", "0")
    return F.when(good + bad > 0, bad / (good + bad)).otherwise(bad)


def raw_label(p1: Column) -> Column:
    return (p1 >= 0.5).cast("int")


def gold_class(label: Column, strict: bool = False) -> Column:
    """The class of a data set's label; an unknown one is null, or an error if strict."""
    other = F.raise_error(F.concat(F.lit("unknown label "), label.cast("string"))).cast("string") if strict else F.lit(None).cast("string")
    return F.when(label == 0, V.SAFE).when(label.isin(1, 2), V.INJECTION).otherwise(other)


def model_class(label: Column, strict: bool = False) -> Column:
    other = F.raise_error(F.concat(F.lit("unknown label "), label.cast("string"))).cast("string") if strict else F.lit(None).cast("string")
    return F.when(label == 0, V.SAFE).when(label == 1, V.INJECTION).otherwise(other)


def stub_score(text: Column) -> Column:
    """A deterministic stand-in for a text classifier: a hash between 0 and 1."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
