"""Pieces, token ids, leaks, garbled texts and residue."""

import os
import random
import re

import pytest

from recordmill.llm import chunking, encoding, garbled, leaks, residue
from recordmill.llm.words import WordHashes, slices

WORD = re.compile(r"[^\W_]+")
SAMPLES = ["a paragraph. With sentences!\n\nAnd lines\nof words", "日本語の文。次の文。", "ACGT" * 900, "é" * 5000, "x\r\ny\r\n\r\nz ", "word " * 900, "🧬" * 2000]


def long_texts():
    rng = random.Random(9)
    return [(f"t{k}", "".join(rng.choice(SAMPLES) for _ in range(rng.randint(2, 30)))) for k in range(25)]


def check_pieces(data: bytes, pieces, limit, overlap):
    stop = 0
    for k, (begin, end, piece) in enumerate(pieces):
        assert data[begin:end].decode() == piece and len(piece.encode()) <= limit
        if k:
            assert stop - overlap <= begin <= stop - overlap + 3
            assert begin == stop - overlap or data[stop - overlap] & 0xC0 == 0x80
            assert all(b & 0xC0 == 0x80 for b in data[stop - overlap : begin])
        else:
            assert begin == 0
        stop = end
    assert stop == len(data)


@pytest.mark.parametrize("range_bytes", [300, 4096, 1 << 20])
def test_pieces_cover_their_text(spark, range_bytes):
    rows = [*long_texts(), ("none", None), ("empty", ""), ("fits", "x" * 1000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "item string, text string, piece int").repartition(3)
    got = {}
    for r in chunking.split_texts(df, "item", "text", 1000, 100, range_bytes).collect():
        got.setdefault(r.item, []).append((r.piece_no, r.begin, r.stop, r.piece))
    assert set(got) == {i for i, t in rows if t and len(t.encode()) > 1000}
    for i, t in rows:
        if i in got:
            parts = sorted(got[i])
            assert [p[0] for p in parts] == list(range(len(parts)))
            check_pieces(t.encode(), [p[1:] for p in parts], 1000, 100)


def test_cuts_prefer_paragraphs_lines_sentences_words(spark):
    text = {"paragraph": "\n\n", "line": "\n", "sentence": ". ", "word": " "}
    for mark in text.values():
        body = ("x" * 99 + mark) * 30
        df = spark.createDataFrame([("a", body)], "item string, text string")
        pieces = [r.piece for r in chunking.split_texts(df, "item", "text", 1000, 0).orderBy("piece_no").collect()]
        assert all(p.endswith(mark) for p in pieces) and "".join(pieces) == body


def test_boundary_in_the_lower_half_beats_a_cut_inside_of_a_word(spark):
    body = "word " * 60 + "x" * 900 + " " + "word " * 60
    df = spark.createDataFrame([("a", body)], "item string, text string")
    for n in (300, 64_000):
        cuts = [r.stop for r in chunking.split_texts(df, "item", "text", 1000, 100, n).orderBy("piece_no").collect()]
        assert cuts[0] == 300 and cuts[-1] == len(body)


def whole_text_cuts(data, limit, overlap):
    """The rule for cuts over a text's whole list of boundaries."""
    levels = [[m.end() for m in level.finditer(data)] for level in chunking.LEVELS]
    grid = [k for k in range(1, len(data)) if data[k] & 0xC0 != 0x80 and k % chunking.GRID < 4]
    cut, out = 0, []
    while len(data) - (begin := cut - overlap if cut else 0) > limit:
        top = begin + limit
        low = cut + (top - cut) // 2
        good = [[e for e in level if low < e <= top] for level in levels]
        early = [e for level in levels for e in level if cut + overlap < e <= top]
        cut_at = next((max(x) for x in good if x), max(early, default=0)) or max(e for e in grid if cut < e <= top)
        out.append((begin, cut_at))
        cut = cut_at
    return [*out, (begin, len(data))]


def test_ranges_do_not_change_cuts():
    rng = random.Random(5)
    samples = [*SAMPLES, "\n" + " " * 700 + "\n", "\r\n" * 200, " " * 90, "\n\t \n" * 60, '.")' * 150 + "  ", "。！？　" * 30, "a paragraph"]
    for _ in range(60):
        data = "".join(rng.choice(samples) for _ in range(rng.randint(3, 25))).encode()
        if len(data) > 1000:
            want = whole_text_cuts(data, 1000, 100)
            assert all(chunking.text_pieces(data, 1000, 100, n) == want for n in (256, 300, 512, 4096, 16_384, 1 << 20))


def test_long_blank_space_at_a_range_edge():
    """A paragraph end of 40 blanks lies on the edge of a range of 4,096 bytes."""
    data = ("a word " * 580 + "\n" + " " * 40 + "\n" + "next line\n" * 400).encode()
    assert len({chunking.text_pieces(data, 6000, 200, n)[0] for n in (1024, 4096, 16_384, 1 << 20)}) == 1


def test_files(spark, tmp_path):
    texts = dict(long_texts())
    files = []
    for name, t in texts.items():
        (tmp_path / name).write_text(t, encoding="utf-8", newline="")
        files.append((str(tmp_path / name), os.path.getsize(tmp_path / name)))
    got = {}
    for r in chunking.split_files(spark, files, 1000, 100, 2000).collect():
        got.setdefault(os.path.basename(r.item), []).append((r.piece_no, r.begin, r.stop, r.piece))
    assert set(got) == {n for n, t in texts.items() if len(t.encode()) > 1000}
    for name, parts in got.items():
        parts.sort()
        data = texts[name].encode()
        assert [p[0] for p in parts] == list(range(len(parts)))
        check_pieces(data, [p[1:] for p in parts], 1000, 100)
        assert [p[2] for p in parts] == [stop for _, stop in whole_text_cuts(data, 1000, 100)]


def test_file_whose_chains_never_meet(spark, tmp_path, monkeypatch):
    """Without boundaries no guess of a range's first cut comes true: the file is walked range by range."""
    monkeypatch.setattr(chunking, "ROUNDS", 2)
    data = b"x" * 50_000
    (tmp_path / "x").write_bytes(data)
    got = chunking.split_files(spark, [("file://" + str(tmp_path / "x"), len(data))], 1000, 100, 3000).orderBy("piece_no").collect()
    assert [r.stop for r in got] == [stop for _, stop in whole_text_cuts(data, 1000, 100)]
    check_pieces(data, [(r.begin, r.stop, r.piece) for r in got], 1000, 100)


def test_bad_limits():
    with pytest.raises(ValueError):
        chunking.checked(1000, 500)


def vocabulary():
    if not os.path.exists(encoding.VOCABULARY):
        pytest.skip("no vocabulary here")
    with open(encoding.VOCABULARY, "rb") as f:
        return encoding.load_ranks(f.read())


def test_ids_equal_the_tokenizer(spark):
    ranks = vocabulary()
    tiktoken = pytest.importorskip("tiktoken")
    tokenizer = tiktoken.Encoding("own", pat_str=encoding.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    letters = "aab bcé日ll's  \n12<|endoftext|>🧬\r\t"
    rows = [(k, "".join(rng.choice(letters) for _ in range(rng.randint(0, 80)))) for k in range(3000)] + [(9000, None), (9001, ""), (9002, "ab" * 20_000), (9003, "<|endoftext|>"), (9003, "<|endoftext|>")]
    got = [(r.doc_id, r.ids) for r in encoding.encode(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string"), "doc_id", "text").collect()]
    assert sorted(got) == sorted((i, tokenizer.encode_ordinary(t) if t else []) for i, t in rows)
    assert all(tokenizer.decode(ids) == t for (i, ids), (_, t) in zip(sorted(got, key=lambda x: x[0]), sorted(rows, key=lambda x: x[0]), strict=True) if t)


def test_encoder_forgets(monkeypatch):
    ranks = vocabulary()
    encoder = encoding.Encoder(ranks)
    ids, offsets = encoder(["one two three", "two"])
    monkeypatch.setattr(encoding, "KEPT", 1)
    again, places = encoder(["one two three", None, "two"])
    assert ids.tolist() == again.tolist() and places.tolist() == [0, 3, 3, 4] and offsets.tolist() == [0, 3, 4]


def test_leaks_equal_brute_force(spark):
    rng = random.Random(3)
    pool = [f"w{k}" for k in range(30)]
    items = [(k, " ".join(rng.choice(pool) for _ in range(rng.randint(5, 60)))) for k in range(20)]
    docs = []
    for k in range(300):
        t = [rng.choice(pool) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.5:
            w = items[rng.randrange(20)][1].split()
            a = rng.randrange(len(w))
            t[len(t) // 2 : len(t) // 2] = w[a : a + rng.randint(8, 30)]
        docs.append((k, rng.choice([" ", ", ", "_"]).join(t).upper()))
    docs += [(900, None), (901, ""), (902, items[0][1] + " " + items[0][1]), (902, items[0][1])]
    items += [(50, None), (51, "too short")]

    def hit(doc, item):
        d, w = WORD.findall(doc.lower()), WORD.findall(item.lower())
        joined = " " + " ".join(d) + " "
        return any(f" {' '.join(w[k : k + 12])} " in joined for k in range(len(w) - 11))

    d, i = spark.createDataFrame([(a, t, 1) for a, t in docs], "doc_id long, text string, item_id int"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.leaks(d, i, "doc_id", "item_id").collect()}
    assert got == {(a, b) for a, t in docs for b, w in items if t and w and hit(t, w)}
    assert leaks.leaks(d.where("false"), i, "doc_id", "item_id").count() == 0
    assert leaks.leaks(d, i.where("false"), "doc_id", "item_id").count() == 0


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_leaks_of_sent_and_of_joined_items(spark, monkeypatch, most):
    monkeypatch.setattr(leaks, "ITEM_BYTES", most)
    rng = random.Random(8)
    pool = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rng.choice(pool) for _ in range(rng.randint(5, 50)))) for k in range(30)]
    docs = [(k, " ".join(rng.choice(pool) for _ in range(20)) + " " + " ".join(items[k % 30][1].split()[3 : 3 + k % 25])) for k in range(200)]
    docs += [(7, docs[8][1]), (500, None)]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*items, (90, None), items[0]], "item_id long, text string")

    def near(doc, item, slop):
        d, w = doc.split(), item.split()
        starts = [*range(0, len(w) - 12, 6), len(w) - 12] if len(w) >= 12 else []
        return any(set(w[k : k + 12]) <= set(d[j : j + 12 + slop]) for k in starts for j in range(max(1, len(d) - 12 - slop + 1)))

    got = {(r.doc_id, r.item_id) for r in leaks.leaks(d, i, "doc_id", "item_id").collect()}
    phrase = lambda t, w: any(f" {' '.join(w.split()[k : k + 12])} " in f" {t} " for k in range(len(w.split()) - 11))
    assert got == {(a, b) for a, t in docs for b, w in items if t and phrase(t, w)} and len(got) > 40
    got = {(r.doc_id, r.item_id) for r in leaks.leaks(d, i, "doc_id", "item_id", slop=3).collect()}
    assert got == {(a, b) for a, t in docs for b, w in items if t and near(t, w, 3)} and len(got) > 20
    assert leaks.leaks(d.where("false"), i, "doc_id", "item_id").count() == leaks.leaks(d, i.where("false"), "doc_id", "item_id", slop=1).count() == 0


def test_work_follows_matches_and_not_items():
    """Of very many items only those whose blocks occur in a part are searched."""
    many = leaks.Items([(k, " ".join(f"w{k + j}" for j in range(20))) for k in range(0, 40_000, 2)], 12)
    index = leaks.Postings(["w7 " * 50 + " ".join(f"w{k}" for k in range(100, 130)) + " other"] * 3, many)
    assert len(index.blocks()) < 60 and {s[0] for s in index.spans(None)} == {k for k in range(92, 119, 2)}


def test_proximity(spark):
    words = [f"w{k}" for k in range(12)]
    mixed = words[6:] + ["x", "y"] + words[:6]
    d, i = spark.createDataFrame([(1, " ".join(mixed)), (2, " ".join(words[:11])), (3, " ".join(words[:6])), (4, " ".join(words[6:]))], "doc_id long, text string"), spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    got = leaks.spans(d.coalesce(1), i, "doc_id", "item_id", slop=4).collect()
    assert {(r.doc, r.kind) for r in got} == {(1, "proximity")}
    assert leaks.spans(d, i, "doc_id", "item_id", slop=1).count() == 0


SENTENCES = [
    "Für jede Gruppe werden überlappende Zellkerne gezählt und anschließend gespeichert.",
    "Les généalogies éloignées ont été déplacées vers le répertoire créé ; l’outil s’arrête.",
    "Não é possível combinar informações orgânicas sem informar a opção à mão.",
    "El último análisis mostró páginas sin ningún código. ¿Qué ocurre si faltan árboles?",
    "Если гены не найдены, работа завершается после нескольких попыток. Отчёт содержит ошибки.",
    "出力には領域、短い細胞、および警告の件数が含まれます。",
]


@pytest.mark.parametrize("read", ["cp1252", "latin-1", "mac_roman", "cp437", "cp850"])
def test_utf8_read_wrongly_is_restored(read):
    restorer = garbled.Restorer()
    for text in SENTENCES[:4]:
        raw = text.encode("utf-8")
        bad = "".join(bytes([b]).decode(read, "ignore") or chr(b) for b in raw)
        assert restorer(bad) == (True, text)
        if read in ("cp1252", "latin-1"):
            twice = "".join(bytes([b]).decode(read, "ignore") or chr(b) for b in bad.encode("utf-8"))
            assert restorer(twice) == (True, text)


@pytest.mark.parametrize(("written", "read", "text"), [("cp1251", "latin-1", 4), ("koi8-r", "cp1251", 4), ("cp1251", "koi8-r", 4), ("cp866", "cp1251", 4), ("euc_jp", "latin-1", 5), ("shift_jis", "latin-1", 5)])
def test_other_confusions_are_restored(written, read, text):
    assert garbled.Restorer()(SENTENCES[text].encode(written).decode(read)) == (True, SENTENCES[text])


def test_parts_references_and_case_are_restored():
    r = garbled.Restorer()
    assert r("El último anÃ¡lisis mostró páginas") == (True, "El último análisis mostró páginas")
    assert r("reads from caf├® tsv") == (True, "reads from café tsv")
    assert r("l&#195;&#169;gende") == (True, "légende")
    assert r("fã¼r jede gruppe") == (True, "für jede gruppe")
    assert r("The value � is lost")[0]


def test_right_and_quoted_characters_are_left(spark):
    right = [*SENTENCES, *(s.upper() for s in SENTENCES[:4]), "Price: 25 €, 6½ × 28 µm ± 0.82 °C, §9 ¶9, © tool™.", "Ångström, façade, Ærø, Ÿ, Þór, ÃO, Œuvre, ¿¡", "Ânion, Âmbito e São Tomé.", "tool\n└── a.bed\n├── b.csv\n│   ├── c.txt", "α/β-cell, Δcoverage ≈ 0.24, 🧬records 👩‍🔬 étude naïve", "If a name shows up as “Ã©” or “â€™”, it was read wrongly", "&lt;b&gt; &amp; caf&eacute;", "plain"]
    r = garbled.Restorer()
    for text in right:
        assert r(text) == (False, text), text
    df = spark.createDataFrame([(k, t) for k, t in enumerate([*right, None, "", "Ã¼ber"])] + [(77, "Ã¼ber")], "doc_id long, text string")
    assert sorted((x.doc_id, x.restored, x.whole) for x in garbled.restore(df, "doc_id", "text").collect()) == [(len(right) + 2, "über", True), (77, "über", True)]
    assert garbled.restore(df.where("false"), "doc_id", "text").count() == 0


def test_single_odd_characters_are_found():
    r = garbled.Restorer()
    assert r("clusters Ã la smoothed") == (True, "clusters à la smoothed")
    assert r("plasmids Ã  la nested") == (True, "plasmids à la nested")
    assert r("over 10Â cm") == (True, "over 10 cm")
    assert r("the gÈnome is read") == (True, "the génome is read")
    assert r("one cafÈ each") == (True, "one café each")
    assert r("one caf‚ each") == (True, "one café each")
    assert r("reads‡of them")[0] and r("cellÐ of")[0]
    for text in ("MANHÃ E LÃ ", "IRMÃ", "monÉtat", "nombreÉlèves", "col·legi", "the letter “Ã” alone", "les « mots »", "5 µm", "l’été, «là»", "R² and m²", "a→b", "x–y"):
        assert r(text) == (False, text), text


@pytest.mark.parametrize(("written", "read", "word"), [("cp1251", "latin-1", "гены"), ("cp1251", "mac_roman", "файл"), ("koi8-r", "latin-1", "гены"), ("utf-8", "gbk", "出力"), ("utf-8", "cp932", "領域"), ("utf-8", "cp932", "ファイル"), ("euc_jp", "cp932", "細胞"), ("cp932", "gbk", "ファイル")])
def test_short_words_and_asian_readings_are_restored(written, read, word):
    for form in ("Writes the {} of each sample to a café.", "{}"):
        assert garbled.Restorer()(form.format(word.encode(written).decode(read))) == (True, form.format(word))
    for right in ("The файл is read", "The ГОСТ is read", "the 細胞 and 文件 are read", "データ and 出力", "tool\n├── c.txt", "±≤≥ 5"):
        assert garbled.Restorer()(right) == (False, right), right


BAD = ["HTTP Error 404: Not Found", "<html><head><title>503 Service Unavailable</title></head></html>", "Please enable JavaScript to view this page.", "Our site cannot be shown without scripting.", "Lorem ipsum dolor sit amet nulla vitae metus", "Help text will be added later.", "Sorts reads.\n\n{{ short_desc }}\n\n--a  b", "Author: <your author goes here>", "TODO: write param table", "Usage: tool\n\n@CITATION@", "[INSERT LONG HELP HERE]", "SEITE NICHT GEFUNDEN."]
GOOD = ["Filters reads by length and quality before they are merged.", "Usage: tool <reads> <bed> [options]\n  --a INT  length [default: 3]", "Names in --x may hold ``{{gene}}``, which is replaced by the gene name at run time.", "Threads are taken from \\${SLOTS:-4} for sorting.", "Use --x '%(chrom)s_%(start)s' to choose names.", "TODO entries in the sample sheet are skipped.", "usage: tool [-h] [--x N] bed [bed ...]\n\nResponses with status 503 (Service Unavailable) are retried 5 times before the run fails.", "A file such as <name>_<part>.bed is accepted."]


def test_residue(spark):
    rows = [(k, t, None, "fine") for k, t in enumerate([*BAD, *GOOD])] + [(100, None, None, None), (101, "", "  ", "\n"), (0, BAD[0], None, "fine")]
    df = spark.createDataFrame(rows, "pos long, a string, b string, odds string")
    got = {(r.id, r.field) for r in residue.residue(df, "pos", ("a", "b")).collect()}
    assert got == {(k, "a") for k in range(len(BAD))}
    kept = {r.pos for r in residue.clean(df, "pos", ("a", "b")).collect()}
    assert kept == {*range(len(BAD), len(BAD) + len(GOOD)), 100, 101}
    assert residue.residue(df.where("false"), "pos", ("a", "b")).count() == 0


def test_long_placeholders_and_notes_in_long_help():
    model = residue.train([])
    long = "Clusters reads of each sample before they are merged with others. " * 200
    slots = ["[Insert a description of what the tool does with its inputs, which parameters it has and how its outputs are to be read by its users]", "Documentation will be added later.", "Help text for the options to be written."]
    odds = model.residue([long, *(f"{long}\n\n{s}\n\n{long}" for s in slots), long + "Path of the summary to be written. The text to be added to names."], WordHashes())
    assert odds[0] < 0 and odds[-1] < 0 and all(o > 0 for o in odds[1:-1])


def test_very_long_value_with_one_slot():
    model = residue.train([])
    long = "Clusters reads of each sample before they are merged with others. " * 2000
    odds = model.residue([long, long + "\n\nCitation: {{tool.citation}}\n\n" + long], WordHashes())
    assert odds[0] < 0 < odds[1]


def test_fit_separates_and_regularizes():
    import numpy as np

    from recordmill.llm.linear import fit

    owner, features = np.repeat(np.arange(200), 2), np.array([f for k in range(200) for f in (k % 2, 10 + k % 5)])
    labels = np.arange(200) % 2.0
    model = fit(owner, features, np.ones(400), labels)
    odds = model.scores(owner, features, np.ones(400), 200)
    assert ((odds > 0) == (labels > 0)).all()
    assert fit(owner[:0], features[:0], np.ones(0), labels[:0]).scores(owner, features, np.ones(400), 200).sum() == 0


def test_slices_cover_all_texts():
    texts = ["a" * 5, None, "b" * 50, "", "c"] * 3 + [None]
    got = list(slices(texts, 4, 20))
    assert [k for lo, hi in got for k in range(lo, hi)] == list(range(len(texts)))
    assert all(hi - lo <= 4 and (hi - lo == 1 or sum(len(t or "") for t in texts[lo:hi]) <= 20) for lo, hi in got)
    assert list(slices([])) == []


def test_long_runs_are_searched_whole_and_soon():
    import time

    text = "既定では並べ替えた断片を除外し、残りの行列を並べます。長い深度が見つからない場合、処理は停止します。" * 20
    bad = text
    for _ in range(2):
        bad = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in bad.encode("utf-8"))
    began = time.process_time()
    assert garbled.Restorer()(bad) == (True, text)
    assert time.process_time() - began < 20
    mixed = "Die Fehlerstr&#246;me: pr&#195;&#188;ft v├│rher die Gr├Â├ƒe, loci Â± mobility – disÂµ-persion."
    assert garbled.Restorer()(mixed) == (True, "Die Fehlerströme: prüft vórher die Größe, loci ± mobility – disµ-persion.")
    for line in ("loci Â± mobility below 0.66. Quality â€“ disÂµ-persion of genomes", "tool\n├── c.txt\n├───────── d.txt"):
        assert "Ð" not in garbled.Restorer()(line)[1] and not re.search("[Ѐ-ӿ]", garbled.Restorer()(line)[1])


def test_validation_counts_all_rows_of_the_unseen_hosts(spark, monkeypatch):
    hosts = [h for h in map(str, range(200)) if residue._held_out(h)][:4]
    seen = next(h for h in map(str, range(200)) if not residue._held_out(h))
    monkeypatch.setattr(residue, "SAMPLE_ROWS", 10)
    rows = [(k, (BAD[0] if k % 3 == 0 else GOOD[0]), hosts[k % 4] if k % 5 else seen) for k in range(300)]
    got = residue.validation(spark.createDataFrame(rows, "pos long, a string, host string"), "pos", ("a",), "host").first()
    unseen = [r for r in rows if r[2] != seen]
    assert (got.hosts, got["values"], got.weak) == (4, len(unseen), sum(r[1] == BAD[0] for r in unseen)) and got.agreed == got.weak
