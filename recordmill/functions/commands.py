"""Shell commands: segments, tokens and the program and sub-command that a line calls.

Quotes and operators nest, so these are scanners in Arrow UDFs.
"""

from __future__ import annotations

import re
import shlex

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import Text, col

# Words that aren't programs, and programs that run another.
BUILTINS = frozenset("if then else elif fi for while until do done case esac in function set export cd echo mkdir ln cp mv rm cat test true false exit return local read source . [ ]".split())
RUNNERS = frozenset("env exec nice nohup time sudo command".split())
INTERPRETERS = frozenset("python python2 python3 Rscript perl bash sh ruby java node".split())
_NAME = re.compile(r"[A-Za-z_./][\w./+-]*\Z")
_TEMPLATE_LINE = re.compile(r"\s*#(?!\!)|\s*##")


def segments(line: str) -> list[str]:
    """Parts between ``&&``, ``||``, ``;`` and ``|`` outside of quotes."""
    out, now, quote, k = [], [], "", 0
    while k < len(line):
        c = line[k]
        if quote:
            if c == "\\" and quote == '"' and k + 1 < len(line):
                now.append(line[k : k + 2])
                k += 2
                continue
            quote = "" if c == quote else quote
        elif c in "'\"":
            quote = c
        elif c == "\\" and k + 1 < len(line):
            now.append(line[k : k + 2])
            k += 2
            continue
        elif c in ";|" or line.startswith("&&", k):
            out.append("".join(now))
            now = []
            k += 2 if line.startswith(("&&", "||"), k) else 1
            continue
        now.append(c)
        k += 1
    return [s.strip() for s in (*out, "".join(now)) if s.strip()]


def tokens(segment: str) -> list[str]:
    try:
        return shlex.split(segment, comments=False)
    except ValueError:
        return re.findall(r"[^\s'\"]+", segment)


def signature(segment: str) -> tuple[str, str]:
    """(program, sub-command) of a segment; ``python -m x`` calls x; empty where nothing is called."""
    words = tokens(segment)
    while words and ("=" in words[0] and re.match(r"\w+=", words[0]) or words[0] in RUNNERS):
        words = words[1:]
    if not words or words[0] in BUILTINS or not _NAME.match(words[0]) or words[0].startswith(("$", "#")):
        return "", ""
    program, rest = words[0].rsplit("/", 1)[-1], words[1:]
    if program in INTERPRETERS:
        if rest[:1] == ["-m"] and len(rest) > 1:
            program, rest = rest[1], rest[2:]
        elif rest and not rest[0].startswith("-") and _NAME.match(rest[0]):
            program, rest = rest[0].rsplit("/", 1)[-1], rest[1:]
    sub = rest[0] if rest and re.fullmatch(r"[a-z][a-z0-9_-]{1,30}", rest[0]) else ""
    return program, sub


def signatures(text: str | None) -> list[tuple[str, str]]:
    """Distinct (program, sub-command) of a command text, in order; template lines and continuations are minded."""
    joined = re.sub(r"\\\s*\n", " ", text or "")
    found = [signature(s) for line in joined.splitlines() if not _TEMPLATE_LINE.match(line) for s in segments(line)]
    return list(dict.fromkeys(s for s in found if s[0]))


def called(x: Text) -> Column:
    """array of struct(program, subcommand) that a command text calls."""

    @F.pandas_udf("array<struct<program:string,subcommand:string>>")
    def scan(values: pd.Series) -> pd.Series:
        return values.map(lambda v: [{"program": p, "subcommand": s} for p, s in signatures(v)])

    return scan(col(x))


def probes(program: Text, subcommands: Text, flags: tuple[str, ...] = ("--help", "-h")) -> Column:
    """The commands that would show a program's help, each once."""
    subs = F.transform(F.coalesce(col(subcommands), F.array().cast("array<string>")), lambda s: F.concat_ws(" ", col(program), s))
    bases = F.concat(F.array(col(program)), subs)
    return F.array_distinct(F.flatten(F.transform(bases, lambda b: F.array(*[F.concat_ws(" ", b, F.lit(f)) for f in flags]))))


def relevance(program: Text, identity: Text, sources: Text, packages: Text, image: Text, hints: Text, generic_image: Column, strict: bool = False) -> Column:
    """How well a program fits a record; higher is better and under 100 is no candidate.

    ``identity``, ``sources``, ``packages`` and ``hints`` are arrays of names, ``image`` is a name. Fixed values: the
    points for equal and for similar names.
    """
    from .keys import matching_keys
    from .text import command_key

    own = command_key(program)
    keyed = lambda names: F.transform(F.coalesce(col(names), F.array().cast("array<string>")), lambda n: command_key(n))
    same = lambda names: F.exists(keyed(names), lambda k: (k != "") & (k == own))
    near = lambda names: F.exists(keyed(names), lambda k: matching_keys(program if isinstance(program, str) else own, k))
    points = lambda equal, similar, names: F.when(same(names), equal).when(near(names), similar).otherwise(0)
    shown = F.array(F.when(~generic_image, col(image)).otherwise(""))
    total = points(180, 120, identity) + F.when(same(sources), 140).otherwise(0) + points(120, 70, packages) + points(110, 80, shown) + points(90, 55, hints)
    void = generic_image & ~same(sources) & ~same(packages)
    if strict:
        void = void | (~same(sources) & ~near(packages) & ~same(packages) & ~near(shown))
    return F.when((own == "") | void, 0).otherwise(total)


_LIST_CALL = re.compile(r"""(?:subprocess\.)?(?:run|call|check_call|check_output|Popen)\s*\(\s*\[\s*(["'])([^"']+)\1(?:\s*,\s*(["'])([^"']+)\3)?""")
_TEXT_CALL = re.compile(r"""(?:subprocess\.(?:run|call|check_call|check_output|Popen)|os\.system|system)\s*\(\s*f?(["'])(.+?)\1""")


def script_commands(script: str | None) -> list[tuple[str, str]]:
    """(program, sub-command) that a helper script starts, by lists and by command lines, each once."""
    body = script or ""
    found = [signature(" ".join(p for p in (m.group(2), m.group(4) or "") if p)) for m in _LIST_CALL.finditer(body)]
    found += [signature(s) for m in _TEXT_CALL.finditer(body) for s in segments(m.group(2))]
    return list(dict.fromkeys(f for f in found if f[0]))


def helper_paths(command: str | None) -> list[str]:
    """Script files beside the wrapper that a command refers to, each once."""
    return list(dict.fromkeys(re.findall(r"\$__tool_directory__['\"}]*/([\w./-]+\.(?:py|R|r|pl|sh|rb|js))", command or "")))
