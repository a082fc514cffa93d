"""Template residue, filler and error pages in place of real text: a linear classifier on hashed n-grams.

Two kinds of units are judged. A whole value is described by its hashed word n-grams, its length and its
first line; it is residue if it is an error page, a demand to switch on scripts, or stand-in text. A slot,
anything in a value that has the form of a placeholder, is described by its form, its inner words and the
words and marks around it; a value with an unfilled slot is residue too. Weak labels come from response
statuses and phrases, the phrases themselves are training examples, and the fit is on a bounded sample of
rows (``SAMPLE_ROWS``); every row is judged. ``validation`` reports how the classifier agrees with the weak
labels on hosts that its fit didn't see.

Cases: null and blank values are no cases; very long values are taken whole; equal values are judged
alike; a value over a quarter of whose words lie outside of residue sentences isn't weakly labelled as
residue; no rows give no rows, and the phrases alone then make the classifier; other columns aren't read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .linear import BITS, Linear, fit
from .words import WORD, WordHashes, hashed_words, mix, slices

#: Rows that the classifier is fitted on at most, and the longest value of them.
SAMPLE_ROWS, SAMPLE_CHARS = 6_000, 6_000

# What weakly labels a sentence. Case is ignored.
ERROR_PHRASES = [
    r"\b(?:http|https)(?:/[\d.]+)?\s+(?:error\s+)?[45]\d\d\b", r"\b(?:error|erreur|fehler|erro|ошибка)\s*:?\s*[45]\d\d\b", r"returned error: ?[45]\d\d",
    r"\b[45]\d\d\s+(?:not found|forbidden|gone|bad gateway|service (?:temporarily )?unavailable|internal server error|too many requests|gateway time-?out|authorization required|unauthorized|bad request)",
    r"^\W*(?:not found|forbidden|gone|bad gateway|service (?:temporarily )?unavailable|internal server error|too many requests|gateway time-?out|authorization required|unauthorized|bad request)\W*$",
    r"page not found|seite nicht gefunden|existiert nicht|est introuvable|página não encontrada|página no encontrada|страница не найдена|ページが見つかりません|see at this address|no such page|link is broken",
    r"(?:could|can)(?:not| not|n't) find the page|moved or deleted|could not be served|do(?:es)? not have permission|access (?:is|was|has been) denied|access denied\W*$|access to .{1,60} (?:is|was) denied|rate limit exceeded|session .{0,40}(?:has )?expired|[\"'](?:status|code|error)[\"']?: ?[\"']?[45]\d\d\b",
    r"down for maintenance|back soon|try again later|unexpected error|something went wrong|hit a snag|closed the connection|did not answer|returned nothing|origin unreachable|bad gateway|gateway timeout|host error",
    r"checking your browser|sign in to continue|log ?in to continue|ray (?:id)?\W*[0-9a-f]{6}|request id|^\W*incident\b|^\W*(?:oops|whoops|uh oh|sorry)\b|report this problem|skip to (?:main )?content|back to (?:the )?start page|^\W*(?:home|start) \|",
    r"curl: \(\d+\)|wget: |</?(?:html|head|body|title|hr|center|noscript)\b|&lt;/?noscript",
]
SCRIPT_PHRASES = [
    r"(?:enable|activate|activez|active|activa|ative|aktivieren|allow|turn on|switch on|needs?|requires?|relies on|without|sans|sin|sem|ohne|benötigt|must have|not available|(?:is|are|be) (?:disabled|blocked|turned off|switched off)|включите|有効).{0,60}(?:javascript|scripts?|scripting|cookies)",
    r"(?:javascript|scripts?|scripting|cookies)\b.{0,60}(?:enabled?|disabled|blocked|turned off|switched off|not available|required|aktivieren|benötigt|eingeschaltet|activé|habilitado|ativado|включ|有効)",
    r"javascript.{0,12}(?:ein|в браузере)|browser (?:is|seems) (?:out of date|too old)|turn (?:it|them|this) on and reload|reload after changing|^\W*loading\W*$|stays empty|bitte aktivieren|активируйте",
]
FILLER_PHRASES = [
    r"\b(?:lorem|ipsum|dolor sit|amet|vitae|nulla|metus|augue|ornare|velit|mattis|sapien|tellus|ligula|porta|risus|cursus|felis)\b.{0,40}\b(?:lorem|ipsum|dolor|amet|vitae|nulla|metus|augue|ornare|velit|mattis|sapien|tellus|ligula|porta|risus|cursus|felis)\b",
    r"\btext text\b|example content|dummy (?:text|content)|placeholder (?:text|content)|sample text|filler text|^\W*(?:content|text|description|help) here\W*$|(?:content|text|help|description) here for|blindtext|texte de remplissage",
    r"\b(?:help|text|description|documentation|content|page|manual|usage|summary)\b.{0,60}\b(?:goes here|should go here|go(?:es)? in here|will be (?:added|written|filled in)|to be (?:added|written|filled in)|is being written|follows soon|follows later|coming soon|under construction|be filled in)\b",
    r"^\W*(?:your|a|the)\b.{0,60}\b(?:goes here|should go here|to be filled in|be filled in here)", r"^\W*(?:describe|explain|document|insert|write|put|enter|add|fill in|replace)\b.{0,60}\b(?:here|this text)\b",
    r"^\W*(?:(?:foo|bar|baz|qux|asdf|qwer|qwerty|zzz|xxx|yyy|blah|bla|dummy|test|abc|hello)\b\W*)+$",
    r"coming soon|watch this space|\bto be written\b|\btba\b|\btbd\b|under construction|replace this text",
]
#: Real sentences that speak of the same things.
REAL_SENTENCES = [
    "The interactive report needs JavaScript in the browser; the table works without it.",
    "Responses with status 503 (Service Unavailable) are retried 5 times before the run fails.",
    "An 'Access denied' answer from the server ends the download.",
    "treat '404 Not Found' answers of the mirror as missing samples and go on.",
    "The page is written without scripts, so that blocked JavaScript does no harm.",
    "TODO entries in the sample sheet are skipped.",
    "fills the placeholder %s (letter 3) in names.",
    "Deprecated, see the other tool.", "Moved to another collection.", "Note: maintained by the core group.", "Part of a suite.",
]
#: Names of what a template leaves to fill in.
SLOT_NAMES = ["tool_name", "short_desc", "description", "help", "long_help", "citation", "author", "maintainer", "license_note", "param_table", "example_call", "version", "usage", "summary", "title", "name", "contact", "license", "homepage", "email", "synopsis", "output_table", "date", "inputs", "outputs", "input", "output", "parameters", "options", "examples", "requirements", "references", "notes", "changelog", "url"]
#: Forms of placeholders, in the order in which they are looked for.
FORMS = [
    ("mustache", r"\{\{[^{}]+\}\}"), ("tag", r"\{%[^%]+%\}"), ("dollar", r"\$\{[^{}]+\}"), ("erb", r"<%=?[^%]+%>"), ("printf", r"%\([^()\n]+\)[sdr]?"),
    ("bracket", r"\[\[[^\[\]]+\]\]"), ("insert", r"\[(?:insert|add|fill|your|todo|tbd|describe|write|put)\b[^\[\]]*\]"), ("yours", r"<(?:your|insert|add|enter|put|todo|describe)\b[^<>]+>"),
    ("brace", r"\{[A-Za-z][\w .-]+\}"), ("percent", r"%[A-Z][A-Z_]+%"), ("at", r"@[A-Z][A-Z_]{2,}@"), ("dunder", r"__[A-Z][A-Z_]+?__"),
    ("todo", r"\b(?:TODO|FIXME|XXX|TBD)\b[:(\- ]?[^\n.]{0,60}"),
    # A whole sentence that says so: "the summary to be written" inside of one is an output.
    ("later", r"(?:(?<=[.!?] )|(?<=\n)|(?<!.))[ \t]*(?:(?:the|this|more|further|your)[ ])?(?:help|text|description|documentation|content|page|manual|usage|summary)\b[^\n.]{0,60}\b(?:(?:will be|to be|is being) (?:added|written|filled in)(?: (?:later|soon|here))?|(?:should )?go(?:es)? (?:in )?here|follows (?:soon|later)|coming soon|under construction)(?=[ \t]*(?:[.!)\n]|\Z))"),
]
SLOT = re.compile("|".join(f"(?P<{name}>{form})" for name, form in FORMS), re.I)
MAY_HOLD_SLOT = re.compile(r"[{%@\[$]|<%|<(?i:your|insert|add|enter|put|todo|describe)\b|__[A-Z]|\b(?i:TODO|FIXME|XXX|TBD)\b|\b(?i:added|written|filled in|here|follows|soon|later|construction)\b")
NEAR = re.compile(r"\w+|[^\w\s]")
SENTENCE = re.compile(r"(?<=[.!?。])\s+|\n+")
_RESIDUE = [re.compile(p, re.I) for p in (*ERROR_PHRASES, *SCRIPT_PHRASES, *FILLER_PHRASES)]
_REAL = re.compile(r"works without|retried|\banswers?\b.{0,40}\b(?:of|from|ends)|does no harm|\bentries\b|placeholder (?:%|for)|\(letter", re.I)


def weak_value(text: str) -> bool:
    """Whether most of a value is sentences with a response status or phrase of residue.

    A value with less than a quarter of residue in its first 60 words isn't looked at further.
    """
    residue = total = 0
    for sentence in SENTENCE.split(text):
        n = max(1, len(WORD.findall(sentence))) if sentence.strip() else 0
        total += n
        if n and not _REAL.search(sentence) and any(p.search(sentence) for p in _RESIDUE):
            residue += n
        if total > 60 and residue * 4 < total:
            return False
    return residue > 0 and residue * 4 >= total * 3


@dataclass
class Slot:
    form: str
    inner: str
    left: str
    right: str

    @property
    def quoted(self) -> bool:
        return self.left[-1:] in ("`", "'", '"', "\\") or self.right[:1] in ("`", "'", '"')


def slots(text: str) -> list[Slot]:
    if not MAY_HOLD_SLOT.search(text):
        return []
    return [Slot(m.lastgroup, m.group(), text[max(0, m.start() - 40) : m.start()], text[m.end() : m.end() + 40]) for m in SLOT.finditer(text)]


def weak_slot(slot: Slot) -> bool:
    """Whether a placeholder isn't quoted and names what a template leaves to fill in."""
    if slot.quoted:
        return False
    inner = re.sub(r"[^a-z_ .:]", " ", slot.inner.lower()).strip()
    if slot.form == "todo":
        return bool(re.match(r"(?i)(?:todo|fixme|xxx|tbd)\s*[:(\-]", slot.inner))
    if slot.form in ("insert", "yours", "later") or re.match(r"(?:tool|cookiecutter)\.", inner):
        return True
    names = set(re.split(r"[ .:]+", inner)) | {inner.replace(" ", "_").strip("_"), inner.strip("_")}
    return bool(names & set(SLOT_NAMES))


_HASHED: dict[str, int] = {}


def _feature(name: str) -> int:
    found = _HASHED.get(name)
    if found is None:
        if len(_HASHED) > 300_000:
            _HASHED.clear()
        found = _HASHED[name] = xxhash.xxh3_64_intdigest(name) >> (64 - BITS)
    return found


def slot_features(slot: Slot) -> list[int]:
    inner = re.findall(r"[a-z]+", slot.inner.lower())
    left, right = NEAR.findall(slot.left)[-3:], NEAR.findall(slot.right)[:3]
    names = [f"form {slot.form}", f"inner {'_'.join(inner)}", f"form {slot.form} {'_'.join(inner)}", f"before {slot.left[-1:]!r}", f"after {slot.right[:1]!r}", f"around {slot.left[-1:]!r}{slot.right[:1]!r}", f"upper {slot.inner.isupper()}", f"colon {':' in slot.inner[:6]}"]
    names += [f"in {w}" for w in inner] + [f"in {slot.form} {w}" for w in inner] + [f"in {a} {b}" for a, b in zip(inner, inner[1:])] + [f"left {w.lower()}" for w in left] + [f"right {w.lower()}" for w in right]
    return [_feature("slot " + n) for n in names]


_B = np.uint64(64 - BITS)
_K, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def value_features(texts: list[str], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value): word n-grams of one and two words by share, buckets of length, the first line, marks."""
    flat, offsets = hashed_words(texts, hashes)
    counts = np.diff(offsets)
    row = np.repeat(np.arange(len(texts)), counts)
    share = 4.0 / np.maximum(counts, 1)
    one = (mix(flat * _K) >> _B).astype(np.int64)
    pair = row[:-1] == row[1:] if len(row) > 1 else np.zeros(0, bool)
    two = (mix(flat[:-1] * _K2 + flat[1:]) >> _B).astype(np.int64)[pair] if len(row) > 1 else np.zeros(0, np.int64)
    rows, features, values = [row, row[:-1][pair]], [one, two], [share[row], share[row[:-1][pair]]]
    own, names = [], []
    for k, t in enumerate(texts):
        n, first = int(counts[k]), t.lstrip()[:120].split("\n", 1)[0]
        head = WORD.findall(first.lower())[:6]
        marks = [f"length {min(12, n.bit_length())}", f"title {'#' in first[:3] or first.endswith(':') or first.startswith('**')}", f"usage {'usage' in first.lower()}", f"lines {min(6, t.count(chr(10)))}", f"options {min(3, t.count(' --'))}", f"upper {t.isupper()}", f"ends {t.rstrip()[-1:]!r}", f"tags {min(2, t.count('</'))}", f"begins {' '.join(head[:2])}"]
        marks += [f"head {w}" for w in head]
        own += [k] * len(marks)
        names += [_feature("value " + m) for m in marks]
    rows.append(np.array(own, np.int64))
    features.append(np.array(names, np.int64))
    values.append(np.full(len(own), 0.5))
    return np.concatenate(rows), np.concatenate(features), np.concatenate(values)


@dataclass
class Model:
    values: Linear
    slots: Linear

    def value_odds(self, texts: list[str], hashes: WordHashes) -> np.ndarray:
        row, feature, value = value_features(texts, hashes)
        return self.values.scores(row, feature, value, len(texts))

    def slot_odds(self, found: list[Slot]) -> np.ndarray:
        each = [slot_features(s) for s in found]
        row = np.repeat(np.arange(len(found)), [len(e) for e in each])
        feature = np.array([f for e in each for f in e], np.int64)
        return self.slots.scores(row, feature, np.ones(len(feature)), len(found))

    def residue(self, texts: list[str], hashes: WordHashes) -> np.ndarray:
        """For each value, the larger log odds of itself and of its slots."""
        odds = self.value_odds(texts, hashes)
        found = [(k, s) for k, t in enumerate(texts) for s in slots(t)]
        if found:
            np.maximum.at(odds, np.array([k for k, _ in found]), self.slot_odds([s for _, s in found]))
        return odds


def _phrase_values() -> list[tuple[str, bool]]:
    """Texts that the phrases stand for."""
    statuses = [(404, "Not Found"), (403, "Forbidden"), (500, "Internal Server Error"), (502, "Bad Gateway"), (503, "Service Unavailable"), (504, "Gateway Time-out"), (429, "Too Many Requests"), (401, "Unauthorized"), (410, "Gone")]
    bad = [f'{{"message": "{name}", "status": {code}}}' for code, name in statuses] + [f"{code} {name}" for code, name in statuses] + [f"HTTP Error {code}: {name}" for code, name in statuses] + [f"<html><head><title>{code} {name}</title></head><body><center><h1>{code} {name}</h1></center></body></html>" for code, name in statuses]
    bad += [f"curl: (22) The requested URL returned error: {code}" for code, _ in statuses] + [f"wget: server returned error: HTTP/1.1 {code} {name}" for code, name in statuses]
    what = ["JavaScript", "scripts", "scripting", "JavaScript and cookies"]
    bad += [f"{verb} {w} {end}" for w in what for verb in ("Please enable", "Allow", "Turn on", "You need to enable", "Please activate") for end in ("to continue.", "to view this page.", "in your browser and reload.")]
    bad += [f"{place} {need} {w}." for w in what for place in ("This page", "This site", "Our site", "The manual", "This app") for need in ("requires", "needs", "relies on", "does not work without", "cannot be shown without")]
    bad += [f"{w} {is_} in your browser." for w in what for is_ in ("is disabled", "seems to be disabled", "is turned off", "is blocked", "is not available")]
    bad += ["Bitte aktivieren Sie JavaScript, um diese Seite anzuzeigen.", "Cette page ne fonctionne pas sans JavaScript.", "Active JavaScript en su navegador para continuar.", "Ative o JavaScript no seu navegador para continuar.", "Для работы страницы включите JavaScript.", "このページを表示するにはJavaScriptを有効にしてください。"]
    bad += [f"{w} {end}" for w in ("Help", "Text", "Documentation", "Description", "Page", "Your help text") for end in ("goes here.", "will be added later.", "is being written.", "follows soon.", "under construction.", "to be written.", "coming soon.")]
    bad += ["Lorem ipsum dolor sit amet.", "Lorem ipsum dolor sit amet, consectetur adipiscing elit. Nulla vitae metus augue.", "Placeholder text.", "Dummy text.", "Example content.", "Text text text.", "Content here.", "Replace this text.", "Describe the tool here.", "Explain the option here.", "Document the tool here.", "TBD", "foo bar baz", "asdf qwer asdf", "test test", "dummy zzz blah bar", "blah blah blah", "xxx xxx", '{"message": "Not Found", "status": 404}', '{"message": "Internal Server Error", "status": 500, "ref": "0"}', "Sign in to continue to this page. Session 1a has expired.", "Access to this page is denied. You do not have permission to view this page.", "Page not found.", "Seite nicht gefunden.", "Page introuvable.", "Página no encontrada.", "Access denied.", "Please try again later.", "Something went wrong.", "Rate limit exceeded.", "This site is down for maintenance."]
    good = [*REAL_SENTENCES, "Usage: tool [options] input output", "Filters reads by length.", "Sorts a table.", "Converts one format into another.", "usage: tool [-h] [--length N] table [table ...]", "Usage: tool {sort,filter,merge} ..."]
    return [(t, True) for t in bad] + [(t.upper(), True) for t in bad[::3]] + [(t, False) for t in good for _ in range(3)]


def _phrase_slots() -> list[tuple[Slot, bool]]:
    shapes = {"mustache": ["{{ %s }}", "{{%s}}", "{{tool.%s}}", "{{cookiecutter.%s}}"], "tag": ['{%% include "%s.rst" %%}'], "dollar": ["${%s}"], "erb": ["<%%= %s %%>"], "printf": ["%%(%s)s"], "bracket": ["[[%U]]"], "insert": ["[INSERT %W HERE]", "[add %w]"], "yours": ["<your %w goes here>", "<insert %w>"], "brace": ["{%s}"], "percent": ["%%%U%%"], "at": ["@%U@"], "dunder": ["__%U__"], "todo": ["TODO: %w", "TODO: write %w", "FIXME: %w"]}
    ordinary = ["gene", "sample", "read", "length", "cohort", "start", "region", "count"]
    around = [("\n\n", "\n"), (" ", " "), ("  ", "."), ("", ""), ("Author: ", "\n"), ("\n", "\n\n")]
    out = []
    for form, patterns in shapes.items():
        for pattern in patterns:
            for k, name in enumerate([*SLOT_NAMES, *ordinary]):
                text = pattern.replace("%U", name.upper()).replace("%W", name.upper().replace("_", " ")).replace("%w", name.replace("_", " ")).replace("%s", name).replace("%%", "%")
                left, right = around[k % len(around)]
                unfilled = name in SLOT_NAMES or form in ("insert", "yours", "todo", "mustache", "tag", "erb", "bracket", "dunder", "dollar")
                out.append((Slot(form, text, left, right), unfilled))
                out += [(Slot(form, text, f"Names may hold {q}", f"{q}, which is replaced"), False) for q in ("``", "'")] if k % 2 else [(Slot(form, text, "taken from \\", " for"), False)]
    out += [(Slot("todo", f"TODO {w} in the sheet are skipped", left, "."), False) for w in ("entries", "items", "rows", "marks") for left in ("", "\n", "  ")]
    says = ("will be added later", "will be written", "to be written", "to be added", "is being written", "goes here", "follows soon", "coming soon", "under construction", "will be filled in later")
    out += [(Slot("later", f"{w} {end}", left, "."), True) for w in ("Help text", "Documentation", "Description", "The manual", "Usage") for end in says for left in ("", "\n\n", ". ")]
    out += [(Slot("mustache", f"{{{{{w}}}}}", "may hold ``", "``, which is replaced"), False) for w in ordinary]
    return out


def _values(rows: DataFrame, id_col: str, fields: tuple[str, ...]) -> DataFrame:
    """(id, field, text) of the values that aren't blank."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields]))
    return rows.select(F.col(id_col).alias("id"), each.alias("v")).select("id", "v.field", "v.text").where(F.col("text").rlike(r"\S"))


def _sample(rows: DataFrame, id_col: str, fields: tuple[str, ...], host: str | None) -> list:
    """At most SAMPLE_ROWS rows, spread by a hash of the id, that the classifier is fitted on."""
    share = max(1, int(rows.count() / (SAMPLE_ROWS * 0.8)))
    part = rows.where(F.pmod(F.xxhash64(id_col), F.lit(share)) == 0).limit(SAMPLE_ROWS)
    host_key = F.coalesce(F.col(host), F.lit("")) if host else F.lit("")
    return part.select(host_key.alias("host"), *[F.substring(f, 1, SAMPLE_CHARS).alias(f) for f in fields]).collect()


def train(texts: list[str], seed: int = 1) -> Model:
    """A model from values, by their weak labels, and the phrases."""
    hashes = WordHashes()
    labelled = [(t, weak_value(t)) for t in texts]
    filled = [(s, weak_slot(s)) for t in texts for s in slots(t)]
    labelled += _phrase_values()
    filled += _phrase_slots()
    row, feature, value = value_features([t for t, _ in labelled], hashes)
    order = np.argsort(row, kind="stable")
    values = fit(row[order], feature[order], value[order], np.array([y for _, y in labelled], float), seed=seed)
    each = [slot_features(s) for s, _ in filled]
    row = np.repeat(np.arange(len(filled)), [len(e) for e in each])
    feature = np.array([f for e in each for f in e], np.int64)
    return Model(values, fit(row, feature, np.ones(len(feature)), np.array([y for _, y in filled], float), seed=seed))


def judged(rows: DataFrame, id_col: str, fields: tuple[str, ...]) -> DataFrame:
    """(id, field, odds) of every value that isn't blank; positive log odds are residue."""
    model = train([r[f] for r in _sample(rows, id_col, fields, None) for f in fields if r[f] and r[f].strip()])
    sent = rows.sparkSession.sparkContext.broadcast((model.values.weights.astype(np.float32), model.values.bias, model.slots.weights.astype(np.float32), model.slots.bias))  # 2**BITS numbers each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, c, d = sent.value
        judge, hashes = Model(Linear(a, b), Linear(c, d)), WordHashes()
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo, hi in slices(texts):
                part = batch.slice(lo, hi - lo)
                odds = judge.residue(texts[lo:hi], hashes)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(odds, pa.float64())], names=["id", "field", "odds"])

    kind = rows.schema[id_col].dataType.simpleString()
    return _values(spread(rows), id_col, fields).mapInArrow(run, f"id {kind}, field string, odds double")


def residue(rows: DataFrame, id_col: str, fields: tuple[str, ...]) -> DataFrame:
    """(id, field) of the affected values."""
    return judged(rows, id_col, fields).where("odds > 0").select("id", "field")


def clean(rows: DataFrame, id_col: str, fields: tuple[str, ...]) -> DataFrame:
    """The rows without any affected value."""
    return rows.join(residue(rows, id_col, fields).select(F.col("id").alias(id_col)).distinct(), id_col, "left_anti")


def validation(rows: DataFrame, id_col: str, fields: tuple[str, ...], host: str) -> DataFrame:
    """One row: values of all rows of hosts kept out of the fit, how many are weakly labelled, found and both."""
    sample = [r for r in _sample(rows, id_col, fields, host) if not _held_out(r["host"])]
    model = train([r[f] for r in sample for f in fields if r[f] and r[f].strip()])
    sent = rows.sparkSession.sparkContext.broadcast((model.values.weights, model.values.bias, model.slots.weights, model.slots.bias))  # 2**BITS numbers each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, c, d = sent.value
        judge, hashes = Model(Linear(a, b), Linear(c, d)), WordHashes()
        for batch in batches:
            hosts, *columns = (c.to_pylist() for c in batch.columns)
            each = [(h, t) for h, *values in zip(hosts, *columns, strict=True) if _held_out(h) for t in values if t and t.strip()]
            for lo, hi in slices([t for _, t in each]):
                texts = [t for _, t in each[lo:hi]]
                found = judge.residue(texts, hashes) > 0
                weak = np.array([weak_value(t) or any(weak_slot(s) for s in slots(t)) for t in texts], bool)
                yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in each[lo:hi]], pa.string()), pa.array(weak), pa.array(found)], names=["host", "weak", "found"])

    values = spread(rows.select(F.coalesce(F.col(host), F.lit("")).alias("host"), *fields)).mapInArrow(run, "host string, weak boolean, found boolean")
    return values.agg(F.countDistinct("host").alias("hosts"), F.count("*").alias("values"), F.count_if("weak").alias("weak"), F.count_if("found").alias("found"), F.count_if(F.col("weak") & F.col("found")).alias("agreed"))


def _held_out(host: str) -> bool:
    return xxhash.xxh3_64_intdigest(host) % 5 == 0
