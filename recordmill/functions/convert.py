"""Conversion of tool descriptions between XML and YAML, and finishing of generated XML, in Arrow UDFs."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import Text, col

# Parameter types of the two forms.
TO_YAML = {"data": "data", "data_collection": "data_collection", "integer": "integer", "float": "float", "boolean": "boolean", "select": "select", "text": "text"}


def identifier(name: str, fallback: str = "parameter") -> str:
    made = re.sub(r"\W+", "_", name.strip()).strip("_").lower()
    return made if made and not made[0].isdigit() else f"{fallback}_{made}".rstrip("_")


def unique(names: list[str]) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for name in names:
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out


def xml_to_yaml(value: str | None) -> str | None:
    """A user-defined tool in YAML with the wrapper's id, inputs, outputs and command; null for what isn't a tool."""
    import yaml

    try:
        root = ET.fromstring(value or "")
    except ET.ParseError:
        return None
    if root.tag != "tool":
        return None
    params = [p for p in root.findall("./inputs//param") if p.get("type") != "hidden"]
    names = unique([identifier(p.get("name") or (p.get("argument") or "").lstrip("-")) for p in params])
    inputs = [{"name": n, "type": TO_YAML.get(p.get("type", "text"), "text"), **({"format": p.get("format")} if p.get("format") else {}), **({"optional": True} if p.get("optional") == "true" else {})} for n, p in zip(names, params, strict=True)]
    results = root.findall("./outputs/data")
    out_names = unique([identifier(o.get("name", ""), "output") for o in results])
    outputs = [{"name": n, "type": "data", "format": o.get("format", "data")} for n, o in zip(out_names, results, strict=True)]
    node = root.find("command")
    command = "".join(node.itertext()).strip() if node is not None else ""
    places = {p.get("name"): n for n, p in zip(names, params, strict=True) if p.get("name")}
    command = re.sub(r"\$\{?([A-Za-z_]\w*)\}?", lambda m: f"$(inputs.{places[m.group(1)]})" if m.group(1) in places else m.group(), command)
    doc = {"class": "UserTool", "id": root.get("id", ""), "version": root.get("version", ""), "name": root.get("name", ""), "inputs": inputs, "outputs": outputs, "shell_command": command}
    return yaml.safe_dump(doc, sort_keys=False, allow_unicode=True)


def yaml_to_xml(value: str | None) -> tuple[str | None, list[str]]:
    """(wrapper, notes on what couldn't be expressed); null where the text is no tool."""
    import yaml

    try:
        doc = yaml.safe_load(value or "")
    except yaml.YAMLError:
        return None, ["not YAML"]
    if not isinstance(doc, dict) or not str(doc.get("class", "")).endswith("UserTool"):
        return None, ["no tool"]
    notes = []
    root = ET.Element("tool", {k: str(doc.get(k, "")) for k in ("id", "name", "version")})
    text = str(doc.get("shell_command", ""))
    rest = [e for e in re.findall(r"\$\(([^)]*)\)", text) if not re.fullmatch(r"inputs\.\w+(?:\.path)?", e)]
    notes += [f"expression kept: {e}" for e in dict.fromkeys(rest)]
    ET.SubElement(root, "command").text = re.sub(r"\$\(inputs\.(\w+)(?:\.path)?\)", r"$\1", text)
    for section, tag in (("inputs", "param"), ("outputs", "data")):
        parent = ET.SubElement(root, section)
        for item in doc.get(section) or []:
            if isinstance(item, dict):
                ET.SubElement(parent, tag, {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in item.items() if k in ("name", "type", "format", "optional", "label") and not (tag == "data" and k == "type")})
            else:
                notes.append(f"{section}: {item} left out")
    return ET.tostring(root, encoding="unicode"), sorted(notes)


def finished(value: str | None, tool_id: str | None, name: str | None) -> tuple[str | None, int, bool]:
    """(document with its id and name set and one test left, tests taken out, whether it changed)."""
    try:
        root = ET.fromstring(value or "")
    except ET.ParseError:
        return value, 0, False
    before = ET.tostring(root, encoding="unicode")
    if tool_id:
        root.set("id", tool_id)
    if name:
        root.set("name", name)
    removed = 0
    for parent in root.iter("tests"):
        for extra in parent.findall("test")[1:]:
            parent.remove(extra)
            removed += 1
    after = ET.tostring(root, encoding="unicode")
    return after, removed, after != before


def to_yaml(x: Text) -> Column:
    @F.pandas_udf("string")
    def convert(values: pd.Series) -> pd.Series:
        return values.map(xml_to_yaml)

    return convert(col(x))


def to_xml(x: Text) -> Column:
    """struct(text, notes)."""

    @F.pandas_udf("text string, notes array<string>")
    def convert(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([yaml_to_xml(v) for v in values], columns=["text", "notes"])

    return convert(col(x))


def finish(x: Text, tool_id: Text, name: Text) -> Column:
    """struct(text, removed, changed)."""

    @F.pandas_udf("text string, removed int, changed boolean")
    def run(values: pd.Series, ids: pd.Series, names: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([finished(*row) for row in zip(values, ids, names, strict=True)], columns=["text", "removed", "changed"])

    return run(col(x), col(tool_id), col(name))
