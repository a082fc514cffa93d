"""Expressions on small literal inputs."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordmill.functions import commands, keys, markup, numbers, paths, recipes, text
from recordmill.operators import estimates, relational, texts, versions


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_trimming_and_keys(spark):
    got = values(spark, [(None,), (" \t　a\n b ",), ("",)], "x string", text.stripped("x"), text.single_line("x"), text.blank("x"), text.command_key("x"))
    assert got == [("", "", True, ""), ("a\n b", "a b", False, "ab"), ("", "", True, "")]
    assert one(spark, text.single_line(F.lit("abcdefgh"), 6)) == "abc..."
    assert one(spark, text.slug(F.lit(" a b//c! "))) == "a_b_c"
    assert one(spark, text.file_slug(F.lit("!!"))).startswith("item_")


HELP = ["usage: tool [options]", "Options:\n  -x  y", "  -a one\n  -b two\n  --three", "Tool: x\nSummary: y", "nothing here", "", None]


def test_help_detection(spark):
    assert [r[0] for r in values(spark, [(h,) for h in HELP], "x string", text.looks_like_help("x"))] == [True, True, True, True, False, False, False]


def test_probe_outcomes(spark):
    rows = [("usage: x\n", 0, "help"), ("unknown option\nusage: x", 1, "help-degraded"), ("sh: x: command not found", 127, "failed"), ("tool expects 2 arguments; requires 2 arguments", 1, "usage-degraded"), ("3.2.1", 0, "nonhelp"), ("bad", 127, "failed"), ("warning: unset\nsyntax error\nusage: x", 0, "help"), ("Traceback\nImportError: no", 1, "failed"), (None, None, "nonhelp")]
    got = values(spark, rows, "x string, c int, want string", text.probe_outcome("x", "c"), "want")
    assert all(a == b for a, b in got), got


def test_sections_spans_fences(spark):
    assert one(spark, text.combined_help(F.lit(" a "), F.lit(None).cast("string"), F.lit("\n"), F.lit("b"))) == "a\n\nb"
    assert one(spark, text.spans(F.lit("x <TOOL id='1'>a</tool> <tools></tool> <tool>b</tool>"), "tool")) == ["<TOOL id='1'>a</tool>", "<tool>b</tool>"]
    assert one(spark, text.without_fences(F.lit("```xml\n<a/>\n```"))) == "<a/>"
    assert [one(spark, text.open_fence(F.lit(x))) for x in ("```a", "```a```", "")] == [True, False, False]


def reference_percentile(sorted_values, p):
    k = (len(sorted_values) - 1) * p
    low, high = sorted_values[int(k)], sorted_values[min(int(k) + 1, len(sorted_values) - 1)]
    return round(low + (high - low) * (k - int(k)))


def test_summary_equals_sorted_lists(spark):
    import random

    rng = random.Random(2)
    data = [(g, rng.randint(1, 40)) for g in "abc" for _ in range(rng.randint(1, 60))] + [("d", 5), ("e", None)]
    got = {r.g: r for r in numbers.summary(spark.createDataFrame(data, "g string, v long"), "g", "v").collect()}
    assert set(got) == set("abcd")
    for g in "abcd":
        v = sorted(x for k, x in data if k == g)
        r = got[g]
        assert (r.n, r.least, r.most, round(r.mean, 9)) == (len(v), v[0], v[-1], round(sum(v) / len(v), 9))
        assert [r.p50, r.p90, r.p95, r.p99] == [reference_percentile(v, p) for p in (0.5, 0.9, 0.95, 0.99)]


def test_rates_and_sets(spark):
    got = values(spark, [(1, 4), (1, 0), (0, -1), (None, 2)], "a int, b int", numbers.rate("a", "b"))
    assert [g[0] for g in got] == [0.25, 0.0, 0.0, None]
    rows = [(["a", "b"], ["b", "a"]), ([], []), (["a"], []), (["a", "b"], ["b", "c"])]
    assert [g[0] for g in values(spark, rows, "a array<string>, b array<string>", numbers.jaccard("a", "b"))] == [1.0, 1.0, 0.0, 1 / 3]
    assert one(spark, keys.distinct_strings(F.array(F.lit(" b"), F.lit("a"), F.lit(None), F.lit("b "), F.lit("")))) == ["b", "a"]
    assert one(spark, keys.comma_set(F.array(F.lit("fasta, BAM"), F.lit("bam"), F.lit(",")))) == ["bam", "fasta"]


def test_token_estimate(spark):
    got = values(spark, [(None,), ("",), ("abc",), ("a" * 37,), ("a" * 38,)], "x string", numbers.token_estimate("x"))
    assert [g[0] for g in got] == [1, 1, 1, 10, 11]


def test_images(spark):
    rows = [("host:5000/org/tool:2.1--build",), ("org/tool@sha256:ab",), ("tool",), (None,), ("a b",), ("x{{v}}",), ("-x",), ("p==1",), ("http://x/y",), ("docker://x/y:1",)]
    got = values(spark, rows, "i string", keys.image_name("i"), keys.image_version("i"), keys.image_error("i"))
    assert got[:4] == [("tool", "2.1--build", ""), ("tool", "sha256:ab", ""), ("tool", "", ""), ("", "", "empty")]
    assert [g[2] for g in got[4:]] == ["white space", "placeholder", "leading dash", "double equals sign", "scheme", ""]


@pytest.mark.parametrize(("required", "offered", "want"), [("1.1.1s", "1.1.1a", "mismatch"), ("1.8_4", "1.8-4", "numeric_equivalent"), ("1.0.0", "1", "numeric_equivalent"), (">=v2.0", "2.0", "exact"), ("", "1", "not_required"), ("1", None, "unknown"), ("01.2", "1.2.0", "numeric_equivalent")])
def test_version_match(spark, required, offered, want):
    assert one(spark, keys.version_match(F.lit(required), F.lit(offered).cast("string"))) == want


@pytest.mark.parametrize(("required", "offers", "best", "tier"), [("1.5", ["1.7", "2.0", "1.2"], "1.7", 3), ("1.5", ["1.4", "2.0", "0.9"], "1.4", 4), ("2.0", ["1.1", "1.9", "x"], "1.9", 5), ("1.0", ["1.0.0", "1.1"], "1.0.0", 1), ("3", ["dev"], "dev", 6)])
def test_nearest_version(spark, required, offers, best, tier):
    df = spark.createDataFrame([(required, o) for o in offers], "r string, o string")
    got = df.agg(F.min(keys.version_rank("r", "o")).alias("m")).first()["m"]
    assert (got.version, got.tier) == (best, tier)


def test_natural_order(spark):
    names = ["a10", "a2", "A1", "b1", "a02b", "", "a"]
    got = [r.n for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(keys.natural_key("n"), "n").collect()]
    assert got == ["", "a", "A1", "a2", "a02b", "a10", "b1"]


def test_context_lengths():
    assert estimates.parse_lengths("12k,16384,24k,12k") == (12288, 16384, 24576)
    for bad in ("", "x", "-1", "0k"):
        with pytest.raises(ValueError):
            estimates.parse_lengths(bad)


def test_tasks_and_budgets(spark):
    assert [one(spark, estimates.task_of(F.lit(x))) for x in ("  Convert this", "Generate a", "Repair it", "What")] == ["udt_to_xml", "xml_generate", "xml_repair", "other"]
    assert [one(spark, estimates.budget_for(F.lit(n), [(10, 1), (100, 2)])) for n in (5, 10, 99, 100)] == [1, 1, 1, 2]


def test_collapsed_lines(spark):
    df = spark.createDataFrame([(1, "same\nsame\n\n same \nunique\n\n\nsame"), (2, None)], "id int, t string")
    assert {tuple(r) for r in texts.collapsed(df, "id", "t").collect()} == {(1, 6, 2), (2, 1, 0)}


def test_shape():
    lines = ["intro line number %d" % k for k in range(200)] + ["usage: tool x", "--opt  does it"]
    kept, left = texts.shape("\n".join(lines), 700)
    assert len(kept) <= 700 and "usage: tool x" in kept and "--opt  does it" in kept and left > 0
    assert texts.shape("a  \r\nb", 700) == ("a\nb", 0)


def test_truncate_bytes(spark):
    got = values(spark, [("é" * 10,), ("abc",), (None,)], "x string", texts.truncate_bytes(F.col("x"), 7, "…"))
    assert [g[0] for g in got] == ["éé…", "abc", None]


WRAPPER = """<tool id="a"><command>run $x</command><inputs><param name="x" type="data" format="bam,fasta"/><param type="hidden" name="h"/></inputs>
<outputs><data name="o" format="xml"/></outputs><tests><test/></tests><help>h</help></tool>"""


def test_markup(spark):
    got = values(spark, [(WRAPPER,), ("<macros/>",), ("<broken",), (None,)], "x string", markup.xml_features("x"), markup.structural_report("x"))
    assert got[0][0].inputs == 1 and got[0][0].outputs == 1 and got[0][0].tests == 1 and got[0][0].datatypes == ["bam", "fasta", "xml"] and got[0][0].command == "run $x"
    assert got[0][1].score == 0.95 and got[0][1].inputs == 2
    assert [g[1].score for g in got[1:]] == [0.0, 0.0, 0.0] and not got[2][0].well_formed and got[2][0].inputs is None


def test_diagnostics(spark):
    many = "<tool>" + "".join(f"<option value='v{k}'>l</option>" for k in range(70)) + "<opt"
    rows = [(many,), (WRAPPER,), ("<tool>" + '<param name="same"/>\n' * 14 + "</tool>",), ("<tool>" + " ".join(f"$out_protocol_{k}" for k in range(9)) + "</tool>",), ("<tool><test/><test/><test/></tool>",)]
    got = [g[0] for g in values(spark, rows, "x string", markup.diagnostics("x"))]
    assert got[0].problems == ["no_end_tag", "cut_in_tag", "many_options"] and got[0].options == 70
    assert got[1].problems == [] and got[2].problems == ["repeated_lines"] and got[2].repeated_lines == 1
    assert got[3].problems == ["repeated_fragments"] and got[3].fragments == 9
    assert got[4].problems == ["many_tests"] and got[4].tests == 3


def test_candidate_scores(spark):
    rows = [(WRAPPER, True, True, 0), (WRAPPER, False, None, 3)]
    found = markup.diagnostics("x")
    got = values(spark, rows, "x string, ok boolean, root boolean, unknown int", markup.candidate_score(F.col("ok"), F.col("root"), found, "x", F.col("unknown")))
    assert [g[0] for g in got] == [100 + 100 + 50 + 80 + 60 + 30 + 0 + 15 + 10, -1000 - 500 + 50 + 80 + 60 + 30 + 15 + 10 - 15]


def test_paths(spark):
    rows = [("src/cli.py", False, 60), ("tests/test_x.py", True, 0), ("pkg\\bin\\run", False, 80), ("README.md", False, 55), (".github/workflows/ci.yml", False, -120), ("a/setup.py", False, 70), ("x/tool-main.c", False, 60)]
    got = values(spark, rows, "p string, e boolean, s int", paths.excluded("p"), "e", paths.score("p"), "s")
    assert all(a == b and c == d for a, b, c, d in got), got
    assert one(spark, paths.score(F.lit("src/sam_tools.py"), F.array(F.lit("samtools"), F.lit("SamTools"), F.lit("")))) == 50
    assert [one(spark, paths.sidecar_role(F.lit(n), F.lit(""))) for n in ("a/macros.xml", "tool_data_table_conf.xml.sample", "x.loc.sample", "x.xml")] == ["macros", "data_table", "loc_sample", ""]
    reasons = [("t/a.py", 10), ("u/a.py", 10), ("t/test-data/a.txt", 1), ("t/a.bam", 1), ("t/a.qqq", 1), ("t/a.py", None), ("t/a.py", 10_000)]
    got = values(spark, reasons, "p string, n long", paths.skip_reason("p", F.lit("t"), "n", 1000))
    assert [g[0] for g in got] == ["", "outside_folder", "test_data", "binary_or_data", "unsupported_ending", "missing", "too_large"]
    binary = spark.createDataFrame([(bytearray(b"a\x00b"),), (bytearray(b"plain\n"),), (bytearray(b""),), (bytearray(b"\x01\x02ab"),)], "b binary")
    assert [r.x for r in binary.select(paths.looks_binary(F.col("b")).alias("x")).collect()] == [True, False, False, True]


def test_commands():
    assert commands.segments("a 'x;y' && b | c \"d || e\"; f \\; g") == ["a 'x;y'", "b", 'c "d || e"', "f \\; g"]
    assert commands.signature("X=1 env /usr/bin/samtools sort -o x") == ("samtools", "sort")
    assert commands.signature("python -m pkg.tool run") == ("pkg.tool", "run") and commands.signature("python3 tool.py --x") == ("tool.py", "")
    assert commands.signature("$prog x") == ("", "") and commands.signature("mkdir a") == ("", "") and commands.tokens("a 'b") == ["a", "b"]
    assert commands.signatures("#if $x\nmkdir out &&\nbwa mem \\\n  ref\n#end if\nbwa mem 2") == [("bwa", "mem")]


RECIPE = """{% set version = "1.2" %}
package:
  name: Tool
  version: {{ version }}
source:
  url: https://x.org/tool-{{ version }}-{{ other }}.tar.gz
requirements:
  build:
    - make
  run:
    - python >=3.8  # note
    - numpy
test:
  run:
    - nothing
"""


def test_recipes(spark):
    assert recipes.parse_recipe(RECIPE) == ("tool", "1.2", ["https://x.org/tool-1.2-{{ other }}.tar.gz"], ["python", "numpy"], ["other"]) or recipes.parse_recipe(RECIPE)[3] == ["python", "numpy"]
    assert one(spark, recipes.requirement_name(F.lit(" - 'Sam-Tools >=1.2"))) == "sam-tools" and one(spark, recipes.spec_version(F.lit("x >=1.2,<2"))) == "1.2"
    assert one(spark, recipes.repository(F.lit("https://github.com/o/r.git"))) == "o/r" and one(spark, recipes.repository(F.lit("https://x.org/o/r"))) == ""


def test_macros():
    macros = "<macros><token name='@V@'>1.5</token><xml name='req'><requirements><requirement version='@V@'/><yield/></requirements></xml></macros>"
    out, status = recipes.expanded("<tool><expand macro='req'><container/></expand></tool>", [macros])
    assert status == "expanded" and '<requirement version="1.5" />' in out and "<container />" in out and "<expand" not in out
    assert recipes.expanded("<tool><expand macro='none'/></tool>", [])[1] == "partial"
    assert recipes.expanded("<tool/>", [])[1] == "not_needed" and recipes.expanded("<tool", [])[1] == "failed"


def test_relational(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "y"), (None, 4, "z")], "k string, pos int, v string")
    assert {tuple(r) for r in relational.last_wins(df, ["k"], "pos").collect()} == {("a", 3, None), ("b", 2, "y"), (None, 4, "z")}
    assert {tuple(r) for r in relational.first_wins(df, ["k"], "pos").collect()} == {("a", 1, "x"), ("b", 2, "y"), (None, 4, "z")}
    assert [r["index"] for r in relational.positions(df, "pos").orderBy("pos").collect()] == [0, 1, 2, 3]
    other = spark.createDataFrame([("a", 9, None), ("c", 1, "q")], "k string, pos int, v string")
    got = {r.k: (r.in_left, r.in_right, r.changed) for r in relational.compared(relational.last_wins(df, ["k"], "pos"), other, "k", ["v"]).where("k IS NOT NULL").collect()}
    assert got == {"a": (True, True, []), "b": (True, False, []), "c": (False, True, [])}
    state = lambda *s: spark.createDataFrame([(x,) for x in s], "s string").agg(relational.job_state("s").alias("x")).first()["x"]
    assert (state("completed", "failed"), state("completed", "completed"), state("completed", "pending")) == ("failed", "completed", "running")
    worst = lambda *s: spark.createDataFrame([(x,) for x in s], "s string").agg(relational.worst_status("s", ["failed", "passed"], "none").alias("x")).first()["x"]
    assert (worst("passed", "failed"), worst("passed", "odd"), worst("odd")) == ("failed", "passed", "none")


def test_likeness_of_empty(spark):
    assert one(spark, numbers.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>"))) == 1.0


SCRIPT = """import numpy as np
import os.path
from scipy import stats as st, signal
np.mean(x)
np.mean(y)
os.path.join(a)
st.norm.pdf(1)
signal.detrend(z)
other(1)
"""


def test_script_facts(spark):
    from recordmill.functions import documents

    assert documents.python_calls(SCRIPT) == [("numpy.mean", 4), ("os.path.join", 6), ("scipy.stats.norm.pdf", 7), ("scipy.signal.detrend", 8)]
    assert documents.python_calls(None) == []
    assert one(spark, documents.r_calls(F.lit("dplyr::filter(x) ; dplyr::filter (y) a::b"))) == ["dplyr::filter"]
    docs = one(spark, documents.parameter_docs(F.lit("#define MIN_LEN $x // default: 5 // (int) least length // more\nint a;")))
    assert [tuple(d) for d in docs] == [("MIN_LEN", "$x", "5", "int", "least length more")]


def test_snippets_and_subcommands(spark):
    from recordmill.functions import documents

    body = "\n".join(["a"] * 6 + ["usage: tool x"] + ["b"] * 9 + ["c"] * 20 + ["Usage: tool x"])
    got = one(spark, documents.usage_snippets(F.lit(body)))
    assert [(s.line, s.text.count("\n")) for s in got] == [(7, 10), (37, 3)]
    twice = one(spark, documents.usage_snippets(F.lit("usage: t\n\n\n\n\n\n\n\n\n\n\nusage: t")))
    assert [s.line for s in twice] == [1]
    text_ = "usage: tool {sort,Sort, merge ,help}\n\nCommands:\n  index   makes an index\n  sort    sorts\n\n  no      not\n"
    assert one(spark, documents.usage_subcommands(F.lit(text_))) == ["sort", "merge"]
    assert documents.section_subcommands(text_) == ["index", "sort"]
    assert one(spark, documents.plans(F.lit("tool"), F.lit(text_))) == ["tool sort", "tool merge", "tool index"]
    assert one(spark, documents.plans(F.lit("tool"), F.lit("usage: tool"))) == ["tool"]
    helps = F.create_map(F.lit("Tool  sort"), F.lit("A"), F.lit("tool"), F.lit("B"))
    assert [one(spark, documents.focused_help(helps, F.lit(f))) for f in ("tool sort", "tool merge", "x")] == ["A", "B", ""]


def test_bundle_names(spark):
    import hashlib

    from recordmill.functions import documents

    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    rows = [({"b": "1", "a": "2"},), ({"a": "2"},), ({"a": None, "b": None},), ({},), (None,)]
    got = [g[0] for g in values(spark, rows, "v map<string,string>", documents.bundle_name("v", "0"))]
    assert got == [f"mulled-v2-{sha(chr(10).join('ab'))}:{sha('2' + chr(10) + '1')}-0", "a:2", f"mulled-v2-{sha(chr(10).join('ab'))}:0", "", ""]
    urls = [u.url for u in one(spark, documents.fallback_urls(F.lit("https://github.com/o/r/releases/download/v1/a b.zip")))]
    assert urls == ["https://github.com/o/r/archive/refs/tags/v1.tar.gz", "https://github.com/o/r/releases/download/v1/a%20b.zip"]


def test_conversion(spark):
    from recordmill.functions import convert

    assert convert.unique(["a", "b", "a", "a"]) == ["a", "b", "a_2", "a_3"] and convert.identifier("9 x!") == "parameter_9_x"
    there = convert.xml_to_yaml(WRAPPER.replace("run $x", "run $x ${y} ${x}"))
    assert "shell_command: run $(inputs.x) ${y} $(inputs.x)" in there and "class: UserTool" in there
    back, notes = convert.yaml_to_xml(there)
    assert "<command>run $x ${y} $x</command>" in back and notes == []
    assert convert.yaml_to_xml("class: UserTool\nshell_command: a $(other)")[1] == ["expression kept: other"]
    assert convert.xml_to_yaml("<a") is None and convert.yaml_to_xml("x: [")[0] is None and convert.yaml_to_xml("a: 1") == (None, ["no tool"])
    out, removed, changed = convert.finished("<tool id='a'><tests><test/><test/></tests></tool>", "b", None)
    assert removed == 1 and changed and 'id="b"' in out and convert.finished("<t", "b", "c") == ("<t", 0, False)


def test_wrapper_parts(spark):
    doc = """<tool><requirements><requirement type="package" version="1.2">bwa</requirement><requirement>samtools</requirement><requirement type="set_environment">X</requirement><container>q/c:1</container></requirements>
<command>bwa --help</command><inputs><param name="a" optional="true"/><param type="hidden" name="b"/></inputs><tests><test expect_num_outputs="1"><output name="o" file="f" ftype="bam"/></test></tests><help> one </help></tool>"""
    got = [g[0] for g in values(spark, [(doc,), (WRAPPER,), ("<a",), (None,)], "x string", markup.parts("x"))]
    assert (got[0].help, got[0].packages, got[0].versions, got[0].containers) == ("one", ["bwa", "samtools"], {"bwa": "1.2"}, ["q/c:1"])
    assert got[0].tests[0].expect_outputs == "1" and got[0].tests[0].outputs[0].ftype == "bam" and got[0].help_only and got[0].optional_only
    assert not got[1].help_only and not got[1].optional_only and got[2].help is None and got[3].tests is None


def test_noise(spark):
    assert one(spark, text.without_noise(F.lit("INFO:    Cleaning up image x\nusage: a\n\nINFO: kept"))) == "usage: a\n\nINFO: kept"
    assert one(spark, text.without_error_head(F.lit("\n****\nError: unknown option -x\n warning: y\nusage: a\nerror: b"))) == "usage: a\nerror: b"
    assert one(spark, text.without_error_head(F.lit("error: a"))) == "error: a"


def test_helper_scripts():
    body = "subprocess.run(['bwa', 'mem', x])\nos.system('samtools sort a && echo b')\nsubprocess.check_call([\"bwa\", \"mem\"])\nsubprocess.call(f'python -m tool run {x}')"
    assert commands.script_commands(body) == [("bwa", "mem"), ("samtools", "sort"), ("tool", "run")]
    assert commands.helper_paths("python '$__tool_directory__/a.py' && Rscript $__tool_directory__/b.R; cat $__tool_directory__/x.txt") == ["a.py", "b.R"]
    from recordmill.functions import documents

    assert documents.command_docs("x\nAvailable command line options\n\n-a one\n-b two\n\nrest") == [(2, "Available command line options\n-a one\n-b two")]


def test_command_relevance(spark):
    rows = [("bwa", ["bwa"], [], ["bwa"], "bwa", [], False), ("samtools", ["tools"], ["samtools"], ["sam-tools"], "x", [], False), ("cat", [], [], ["bwa"], "python", [], True), ("", ["a"], [], [], "", [], False), ("bwamem", [], [], ["bwamem2"], "", ["bwa"], False)]
    got = values(spark, rows, "p string, i array<string>, s array<string>, k array<string>, m string, h array<string>, g boolean", commands.relevance("p", "i", "s", "k", "m", "h", F.col("g")))
    assert [g[0] for g in got] == [180 + 120 + 110, 120 + 140 + 120, 0, 0, 70]


def test_repair_samples(spark):
    kind = "array<struct<generated:string,feedback:string>>"
    rows = [(1, [("<a/>", "bad"), ("<b/>", "worse")], None), (2, [("", "x")], [("c", "d")]), (3, None, None)]
    df = spark.createDataFrame(rows, f"pos long, repair_feedback {kind}, wrapper_repair_feedback {kind}")
    assert {tuple(r) for r in estimates.repair_samples(df).collect()} == {(1, 2, "<a/>", "bad"), (2, 1, "c", "d")}
    assert estimates.repair_samples(df.select("pos")).count() == 0


def test_extraction(spark):
    from recordmill.operators import extraction

    doc = "<tool id='a' name=\"A b\" version='1'><requirements><requirement version='2'>bwa</requirement></requirements><command>bwa mem $x | samtools sort</command><inputs><param name='x' format='fasta'/></inputs><help>h</help></tool>"
    df = spark.createDataFrame([(1, doc), (2, "<broken"), (3, None)], "k int, x string")
    got = {r.id: r for r in extraction.records(df, "k", "x").collect()}
    assert (got[1].tool_id, got[1].tool_name, got[1].version, got[1].help, got[1].programs, got[1].packages, got[1].datatypes, got[1].inputs) == ("a", "A b", "1", "h", ["bwa", "samtools"], ["bwa"], ["fasta"], 1)
    assert not got[2].well_formed and got[2].packages == [] and got[3].score == 0.0 and got[3].tool_id == ""
    files = spark.createDataFrame([("t/a.py", "t", "import os\nos.system(x)\n" + "é" * 50), ("t/test-data/b.txt", "t", "x"), ("t/m_macros.xml", "t", "<macros/>"), ("t/n.R", "t", None)], "path string, folder string, content string")
    side = {r.path: r for r in extraction.side_files(files, 40).collect()}
    assert side["t/a.py"].calls == ["os.system"] and side["t/a.py"].kept_bytes <= 40 and side["t/a.py"].kind == "script_template"
    assert side["t/test-data/b.txt"].skip == "test_data" and side["t/m_macros.xml"].role == "macros" and side["t/n.R"].skip == "missing"
    assert [one(spark, extraction.form(F.lit(f))) for f in (" XML", "udt", "yml")] == ["xml", "yaml", "yaml"]
    with pytest.raises(Exception, match="unknown artifact form"):
        one(spark, extraction.form(F.lit("pdf")))
    rows = [(WRAPPER, True, True), ("<tool>", False, False), ("<a></tool>", False, False), ("<x></tool></x>", True, False)]
    got = values(spark, rows, "x string, ok boolean, root boolean", extraction.failure_of(markup.diagnostics("x"), F.col("ok"), F.col("root"), F.lit(0)))
    assert [(g[0].error, g[0].cut) for g in got] == [(None, False), ("the document is cut off", True), ("the document can't be parsed", False), ("the document is no tool", False)]


def test_positions_are_exact_beyond_the_range_sample(spark):
    """Half a million rows with a payload, more than the ranges are sampled from."""
    rows = spark.range(500_000, numPartitions=6).select((F.col("id") * 7919 % 500_009).alias("k"), F.repeat(F.lit("x"), 40).alias("text"), F.rand(3).alias("more"))
    placed = relational.positions(rows, "k", "place")
    want = F.row_number().over(Window.orderBy("k")) - 1
    assert placed.withColumn("want", want).where("place <> want").count() == 0
    assert placed.columns == ["k", "text", "more", "place"] and placed.count() == 500_000


def test_wanted_keeps_equal_rows(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), (None, "z"), (None, None), ("x", "a")], "one string, two string")
    got = relational.wanted(rows, spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "k string"), "k", ["one", "two"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, [r for r in rows.collect() if "a" in (r.one, r.two) or r.two == "z"])) and len(got) == 4


def test_nearest_versions_are_those_of_all_pairs(spark):
    """Without a comparison of all pairs, in groups of versions of all forms."""
    import random

    rng = random.Random(4)
    forms = ["1", "1.0", "1.0.0", "v1", "=1.0", "1-0", "1.0a", "1.0b", "a", "b", "ab", "a.b", ">=", "=", "v", "01", "1.00", "1.0.0.1", "0", "0.0", "00.0", "123456789012345678901.2", "0123456789012345678.2", "x0"]
    made = forms + [".".join(str(rng.choice((0, 0, 1, 2, 5, 9, 11))) for _ in range(rng.randint(1, 5))) + rng.choice(("", "", "", "a", "rc1")) for _ in range(150)]
    rows = [(f"g{g}", rng.choice(made)) for g in range(60) for _ in range(rng.choice((1, 2, 3, 5, 9, 30)))] + [("all", v) for v in made] + [(None, "1"), ("g1", None)]
    df = spark.createDataFrame(rows, "g string, v string")
    ranked = lambda j: {(r.g, r.v): r.best for r in j.groupBy("g", "v").agg(F.min(keys.version_rank("v", "n")).alias("best")).collect()}
    want = ranked(df.distinct().join(df.distinct().select("g", F.col("v").alias("n")), "g").where("v <> n"))
    found = versions.nearest(df, "g", "v")
    got = ranked(found.withColumnRenamed("nearest", "n"))
    assert found.where("v = nearest").count() == 0 and found.count() == len(got)
    assert got == want and {b.tier for b in want.values()} == set(range(7))
