"""Package recipes and macro files: requirement names, variables, sources, and local macro expansion."""

from __future__ import annotations

import copy
import re
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import Text, col, filled

_SET = re.compile(r"""\{%-?\s*set\s+(\w+)\s*=\s*(["'])(.*?)\2\s*-?%\}""")
_USE = re.compile(r"\{\{\s*(\w+)\s*\}\}")


def requirement_name(spec: Text) -> Column:
    """The package of a requirement such as ``tool >=1.2,<2``."""
    return F.lower(F.regexp_extract(F.regexp_replace(filled(spec), r"^\s*-?\s*[\"']?", ""), r"^([A-Za-z0-9][A-Za-z0-9._-]*)", 1))


def spec_version(spec: Text) -> Column:
    """The first version that a requirement names, without its sign."""
    return F.regexp_extract(filled(spec), r"(?:[=<>!~]+|\s)\s*v?(\d[\w.]*)", 1)


def repository(url: Text) -> Column:
    """owner/name of a code-hosting URL; empty for others."""
    return F.regexp_replace(F.regexp_extract(filled(url), r"^(?:https?|git|ssh)://(?:[^@/]*@)?(?:www\.)?git(?:hub|lab)\.com/([\w.-]+/[\w.-]+)", 1), r"\.git$", "")


def rendered(text: str) -> tuple[str, list[str]]:
    """A recipe with its own variables put in, and the names that aren't set; later settings may use earlier ones."""
    values: dict[str, str] = {}
    for name, _, value in _SET.findall(text):
        values[name] = _USE.sub(lambda m: values.get(m.group(1), m.group()), value)
    missing = [n for n in dict.fromkeys(_USE.findall(text)) if n not in values]
    return _USE.sub(lambda m: values.get(m.group(1), m.group()), text), missing


def section_items(text: str, section: str, part: str) -> list[str]:
    """The list under ``part`` of ``section``, by indent."""
    out: list[str] = []
    inside = depth = None
    for line in text.splitlines():
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        indent = len(line) - len(line.lstrip())
        if re.match(rf"{re.escape(section)}\s*:", line):
            inside, depth = indent, None
        elif inside is not None and indent <= inside and not line.lstrip().startswith("-"):
            inside = None
        elif inside is not None and re.match(rf"\s+{re.escape(part)}\s*:\s*$", line):
            depth = indent
        elif depth is not None:
            item = re.match(r"\s*-\s*(.+?)\s*(?:#.*)?$", line)
            if item and indent >= depth:
                out.append(item.group(1).strip("\"'"))
            else:
                depth = None
    return out


RECIPE = "name string, version string, urls array<string>, run array<string>, missing array<string>"


def parse_recipe(text: str | None) -> tuple:
    body, missing = rendered(text or "")
    field = lambda key: (re.search(rf"(?m)^\s+{key}\s*:\s*[\"']?([^\"'#\n]+?)[\"']?\s*(?:#.*)?$", body) or [None, ""])[1]
    urls = [u for u in dict.fromkeys(re.findall(r"(?m)^\s*-?\s*(?:url|git_url)\s*:\s*[\"']?(\S+?)[\"']?\s*$", body)) if "://" in u]
    run = list(dict.fromkeys(re.split(r"[\s<>=!~]", i)[0].lower() for i in section_items(body, "requirements", "run")))
    return field("name").lower(), field("version"), urls, [r for r in run if r], missing


def recipe(x: Text) -> Column:
    """RECIPE of a text."""

    @F.pandas_udf(RECIPE)
    def parse(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse_recipe(v) for v in values], columns=[c.split()[0] for c in RECIPE.split(", ")])

    return parse(col(x))


def expanded(wrapper: str, macro_files: list[str]) -> tuple[str, str]:
    """(wrapper with its macros put in, status): not_needed, expanded, partial or failed."""
    try:
        root = ET.fromstring(wrapper)
        macros: dict[str, ET.Element] = {}
        marks: dict[str, str] = {}
        for source in [*(ET.fromstring(m) for m in macro_files), root]:
            for node in source.iter():
                if node.tag in ("xml", "macro") and node.get("name"):
                    macros[node.get("name")] = node
                elif node.tag == "token" and node.get("name"):
                    marks[node.get("name")] = (node.text or "").strip()
    except ET.ParseError:
        return wrapper, "failed"
    done = left = 0

    def put(parent: ET.Element, depth: int) -> None:
        nonlocal done, left
        for k, child in reversed(list(enumerate(parent))):
            if child.tag != "expand":
                put(child, depth)
                continue
            macro = macros.get(child.get("macro", ""))
            if macro is None or depth > 20:
                left += 1
                continue
            done += 1
            body = copy.deepcopy(macro)
            for place in [p for p in body.iter() if any(c.tag == "yield" for c in p)]:
                at = next(i for i, c in enumerate(place) if c.tag == "yield")
                place.remove(place[at])
                for c in reversed(list(child)):
                    place.insert(at, c)
            put(body, depth + 1)
            parent.remove(child)
            for c in reversed(list(body)):
                parent.insert(k, c)

    put(root, 0)
    out = ET.tostring(root, encoding="unicode")
    for name in sorted(marks, key=len, reverse=True):
        out = out.replace(name, marks[name])
    return out, "partial" if left else "expanded" if done or marks else "not_needed"


def with_macros(x: Text, macros: Text) -> Column:
    """struct(text, status) of a wrapper and an array of macro files."""

    @F.pandas_udf("text string, status string")
    def expand(wrappers: pd.Series, files: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([expanded(w or "", list(f) if f is not None else []) for w, f in zip(wrappers, files, strict=True)], columns=["text", "status"])

    return expand(col(x), col(macros))
