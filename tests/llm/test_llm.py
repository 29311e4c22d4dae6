import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import bpe_fst, formatting_copies, groups, irep, leakage, lookalikes, markup, markup_model, quality, textwords, tokenize
from lexloom.runtime import Workspace

MARKED = [
    "a <b>x</b> c", "a</div> b", "a &nbsp; b", "a [[b|c]] d", "a [[b", "a {{b| c", "''a'' b", "a **b** c", "_a_ b", "`a` b", "~~a~~ b",
    "[a](#b) c", "a [^1] b", "a $x^2$ b", "a \\textbf{b} c", "a \\alpha_{0} b", "x.\n== T ==\n# a\n# b", "x.\n\n## T\n\n- a\n- b",
    "x.\n\nT\n====\na", "x.\n| a | b |\n|---|---|\n| 1 | 2 |", "x.\n;a\n:b", "x.\n> a\n> b", "<!-- a --> b", "__NOTOC__ a", "a <font color=red>b",
    "```\ncode\n```", "x\n\\begin{itemize}\n\\item a\n\\end{itemize}", "a <img\nsrc=x\nalt=y> b", '<span data-x="' + "y" * 900 + '">z</span>',
    "a **b* c* d", "&#" + "0" * 30 + "65; a", "a ```b` — c` d", "''''' a'' b'''",
]
PLAIN = [
    "t >30° и <40°", "a == b", "[ср. выше] x", "a \\ b", "(*) a", "№ #3 a", "<и> — <э>", "5 * 3 = 15", "*е > о", "[0; 1) или {0}",
    "~5 вёрст ≈ 5,3", "1 | 0 — выбор", "x < y и y > z", "А & Б", "a:b::c:d -- e", "main_index a", "100 $ a", "{1, 2, 3}", "5\" a", "a — b", "",
]


@pytest.mark.parametrize("text", MARKED)
def test_markup_is_found(text):
    assert markup.has_markup(text)


@pytest.mark.parametrize("text", PLAIN)
def test_notation_is_left_alone(text):
    assert not markup.has_markup(text) and markup.clean_text(text) == text


CLEANED = [
    (r"Формула $\frac{{a}}{{b}}$ конец", r"Формула $\frac{{a}}{{b}}$ конец"), ("$x_{{i}}$", "$x_{{i}}$"), ("`[[x]]`", "`[[x]]`"),
    ("<pre>if (a < b) { x[[1]] = {{y}} }</pre>", "```\nif (a < b) { x[[1]] = {{y}} }\n```"), (r"\textbf{a {x} b} c", "a {x} b c"),
    (r"a\footnote{note {x} y} b", "a b"), ("![alt text](u.png)", "alt text"), ("{{cite|title=Foo|text=Important text}}", "Foo Important text"),
    ('<a title="a>b">c</a>', "c"), ("{|\n! A !! B\n|-\n| c || d\n|}", "A | B\n\n c | d"), ("a   b\n\n\n\n```\nx   y\n```\nc    d\n\n\n\ne", "a b\n\n```\nx   y\n```\nc d\n\ne"),
    (r"\href{http://a}{text} b", "text b"), ("[[Файл:x.png|мини|подпись]] a", "a"), ("a {{b| c", "a c"), (r"{\it курсив} прямой", "курсив прямой"),
    ("\\begin{equation}\nE = mc^2\n\\end{equation}\nтекст", "$$\nE = mc^2\n$$\nтекст"), ("<nowiki>[[x]]</nowiki> ''y''", "[[x]] y"),
    (r"a \frac{1}{2} b", r"a \frac{1}{2} b"), ("a<ref>прим. [[x]]</ref> b", "a b"), ("T\n====\nx", "# T\nx"), ("T\n----\nx", "## T\nx"),
    ("<ul><li>a</li><li>b</li></ul>", "- a\n\n- b"), ("````\n```\na\n```\n````", "````\n```\na\n```\n````"), ("<h2>T</h2>a", "## T\na"), (r"\title{A {B} C} d", "# A {B} C\n d"),
    ("<script>if (a<b) {}</script> x", "x"), ("1. a\n2. b\n3. c", "1. a\n2. b\n3. c"), ("&lt;b&gt; x", "<b> x"),
]


@pytest.mark.parametrize("text,clean", CLEANED)
def test_clean_text_of_constructs(text, clean):
    assert markup.clean_text(text) == clean


def test_cost_model_on_texts_it_has_not_seen():
    model = markup_model.cost_model()
    right = total = 0
    for text, spans in markup_model.sample(seed=99, size=1500):
        for s in markup.label_segments(text, model):
            if s.kind not in ("run", "code", "brace"):
                total += 1
                right += s.label == any(a <= s.start < b for a, b in spans)
    assert right / total > 0.96


def test_the_cut_decides_where_costs_do_not():
    """A mark of its own is left alone; tied to a sure construct beside it, it goes with it."""
    model = markup_model.cost_model()
    segs = markup.label_segments("a {{x|b [[c|d]] e}} f", model)
    assert [s.text for s in segs if s.kind == "run" and s.label] == ["x|", "c|"]


def test_clean_text_keeps_structure():
    c = markup.clean_text
    assert c("x.\n== T ==\n* a\n* b") == "x.\n## T\n- a\n- b"
    assert c("a <math>x^2</math> b") == "a $x^2$ b" and c("$$\nx_i\n$$ a") == "$$\nx_i\n$$ a"
    assert c("<pre>a  b</pre>") == "```\na  b\n```"
    assert c("{{Card\n| a = {{b|1}}\n}}\nText [[a|b]] {{m|c}}") == "Text b c"
    assert c("\\section*{T} a \\textbf{b}") == "# T\n a b" and c(None) is None
    long = "слово <b>x</b> " * 20_000
    assert "<" not in c(long) and len(c(long)) > 150_000


def test_minimum_cut_against_all_labelings():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 7)
        m, c = [rng.randint(0, 9) for _ in range(n)], [rng.randint(0, 9) for _ in range(n)]
        near = [{} for _ in range(n)]
        for i, j in itertools.combinations(range(n), 2):
            if rng.random() < 0.5:
                near[i][j] = near[j][i] = rng.randint(1, 6)

        def cost(x):
            own = sum(c[i] if x[i] else m[i] for i in range(n))
            return own + sum(w for i in range(n) for j, w in near[i].items() if i < j and x[i] != x[j])

        assert cost(markup.minimum_cut(m, c, near)) == min(cost(x) for x in itertools.product([0, 1], repeat=n))


def test_markup_records(spark):
    senses = spark.createDataFrame([("senses", "1", "a <b>x</b>"), ("senses", "2", None), ("senses", "3", ""), ("senses", "4", "плоско")], "table_name string, record_key string, body string")
    leads = spark.createDataFrame([("candidates", "t", zlib.compress("a ''b''".encode())), ("candidates", "t", zlib.compress("a ''b''".encode())), ("candidates", "u", b"bad")], "table_name string, record_key string, body binary")
    got = markup.records_with_markup(senses, leads).collect()
    assert sorted(map(tuple, got)) == [("candidates", "t"), ("senses", "1")]
    assert markup.cleaned_records(senses, leads).count() == 7
    assert markup.records_with_markup(senses.limit(0), leads.limit(0)).count() == 0


SAME = [("слово", "cлoвo"), ("KT-а", "КТ-a"), ("ab", "a​b"), ("a b", "a b "), ("a-b", "a‑b"), ("fi", "ﬁ"), ("ab", "ａｂ"), ("é", "é"), ("ё", "ё"), ("ο", "о")]
DIFFERENT = [("е", "ё"), ("e", "é"), ("А", "а"), ("за́мок", "замок"), ("a b", "a-b"), ("к", "k"), ("№", "No"), ("a  b", "a b")]


def test_consistent_forms():
    f = lookalikes.consistent_form
    assert all(f(a) == f(b) for a, b in SAME) and all(f(a) != f(b) for a, b in DIFFERENT)
    assert f("cлoвo") == "слово" and f("") == f("​ ") == ""
    assert all(f(f(a)) == f(a) for pair in SAME + DIFFERENT for a in pair)
    assert lookalikes.resolve_token("сор")[1] == "whole" and lookalikes.resolve_token("cлово") == ("слово", "mixed")


def test_same_looking_pairs(spark, monkeypatch):
    values = spark.createDataFrame([("слово",), ("cлово",), ("слово",), (None,), ("",), ("слoво",), ("x",)], "form string")
    got = lookalikes.same_looking_pairs(values, Workspace(spark, "t"))
    words = sorted(["слово", "cлово", "слoво"], key=lambda w: w.encode())
    assert sorted(map(tuple, got.collect())) == sorted(itertools.combinations(words, 2))
    classes = lookalikes.spelling_classes(values, Workspace(spark, "t")).collect()
    assert [(r.spellings, r.least) for r in classes] == [(3, words[0])]
    monkeypatch.setattr(lookalikes, "SPELLINGS_PER_PART", 1)
    split = lookalikes.same_looking_pairs(values, Workspace(spark, "t"))
    assert sorted(map(tuple, split.collect())) == sorted(itertools.combinations(words, 2))
    with pytest.raises(ValueError):
        lookalikes.with_consistent_form(values, "form", "form")


def brute_copies(rows):
    import regex

    def key(x):
        return regex.sub(r"[\p{P}\p{Z}\p{Cc}\p{Cf}\s]+", "", x.upper().lower())

    seen = {}
    out = set()
    for seq, a, b in sorted(r for r in rows if r[1] and r[1].strip() and r[2] and r[2].strip()):
        k = tuple(sorted((key(a), key(b))))
        if k in seen:
            out.add((seen[k], seq))
        else:
            seen[k] = seq
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_formatting_copies(spark, partitions):
    rng = random.Random(2)
    rows = [(n, *rng.choice([("a", "b c"), ("B, c", " A"), ("A.", "b\tc"), ("x", "y"), ("x", "y!"), ("q", "1"), (None, "z"), ("", "z"), (" ", "z")])) for n in range(400)]
    df = spark.createDataFrame(rows, "seq long, lemma string, definition string").selectExpr("*", "'k' as key", "1L as keep_seq")
    runs = formatting_copies.find_runs(df, ["lemma", "definition"], "seq", Workspace(spark, "t"), partitions)
    assert {tuple(r) for r in runs.where("seq <> keep_seq").select("keep_seq", "seq").collect()} == brute_copies(rows)
    whole = formatting_copies.collapse_copies(df.drop("keep_seq"), ["lemma", "definition"], "seq", Workspace(spark, "t"), partitions)
    assert whole.agg(F.sum("copies")).first()[0] == sum(1 for r in rows if r[1] and r[1].strip())
    assert formatting_copies.find_runs(df.limit(0), ["lemma", "definition"], "seq", Workspace(spark, "t"), 2).count() == 0


def test_groups(spark):
    rng = random.Random(3)
    pairs = [(f"w{rng.randint(0, 400)}", f"w{rng.randint(0, 400)}") for _ in range(260)]
    pairs += [(f"c{i:03}", f"c{i + 1:03}") for i in range(120)] + [(f"h{i}", "hub") for i in range(200)]
    pairs += [("self", "self"), (None, "x"), ("", "y"), ("z", None), ("h1", "hub")]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a and b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(pairs, "key string, lemma string").withColumn("v", F.lit(1))
    got = groups.assign_groups(df.repartition(5), "key", "lemma", Workspace(spark, "t"), edges_per_partition=40)
    assert sorted(map(tuple, got.collect())) == sorted((w, find(w)) for w in list(parent))
    assert groups.assign_groups(df.limit(0), "key", "lemma", Workspace(spark, "t")).count() == 0


TEXTS = ["", " ", "  a  b ", "a\n b", "it's we'll", "\n\n\nfoo  ", "日本語🙂👍🏽", "<|endoftext|>", "a" * 3000, "=" * 70, "\r\n\t x", "О том, что\0 y", "слово " * 5000]


def test_transducer_against_the_merge_loop_and_a_library():
    tiktoken = pytest.importorskip("tiktoken")
    path = bpe_fst.vocabulary_path()
    t = bpe_fst.transducer(path)
    enc = tiktoken.Encoding("own", pat_str=bpe_fst.PRETOKEN_PATTERN, mergeable_ranks=t.ranks, special_tokens={})
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choices("абв ab\n\t'1,.ё🙂", k=rng.randint(1, 60))) for _ in range(500)]
    for x in texts:
        assert t.encode(x) == enc.encode_ordinary(x) and t.decode(t.encode(x)) == x
    for x in texts[-100:]:
        b = x.encode()
        assert t.encode_piece(b) == bpe_fst.merge_loop(t.ranks, b)
        assert list(t.stream([b[i : i + 3] for i in range(0, len(b), 3)])) == t.encode_piece(b)
    small = bpe_fst.BpeTransducer(t.ranks, max_transitions=50, max_pieces=5)
    assert all(small.encode(x) == t.encode(x) for x in texts[:40] if len(x) < 200)
    long = b"abcab" * 400
    assert list(t.stream([long])) == t.encode_piece(long)


def test_utf8_machine():
    for data in (b"a\xd0\xb0\xf0\x9f\x99\x82", b"\xd0", b"\xe0\x80a", b"\xf4\x90\x80\x80", b"\xed\xa0\x80", b"\xc0\xaf", b"\xf0\x9fx"):
        m = bpe_fst.Utf8Machine()
        assert "".join(m.feed(bytes((b,))) for b in data) + m.finish() == data.decode("utf-8", "replace")


def test_encode_texts(spark):
    df = spark.createDataFrame([(1, "а б"), (2, None), (3, ""), (1, "а б"), (None, "x")], "doc_id long, text string").selectExpr("*", "1 as ids", "2 as id")
    rows = tokenize.encode_texts(df).collect()
    assert len(rows) == 5 and [r.ids for r in rows if r.doc_id in (2, 3)] == [[], []]
    assert sorted(r.text for r in tokenize.decode_ids(tokenize.encode_texts(df)).collect()) == ["", "", "x", "а б", "а б"]
    assert tokenize.encode_texts(df.limit(0)).count() == 0


def test_leaks(spark):
    words = [f"слово{i}" for i in range(40)]
    text = " ".join(words)
    items = spark.createDataFrame([(1, text), (1, text), (2, "коротко"), (3, None), (None, text)], "item_id long, text string")
    docs = [
        (1, "x " + " ".join(words[5:17]).upper() + " y"), (2, " ".join(words[5:16]) + " y"), (3, ",\n".join(words[:12])),
        (4, " ".join(w[0] + "­" + w[1:4] + "́" + w[4:] for w in words)), (5, None), (6, ""), (7, "z " * 50_000 + text), (None, text),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(9))
    for bound in (leakage.BROADCAST_WINDOWS, 0):
        got = leakage.leaked_items(df, items, broadcast_windows=bound)
        assert sorted(map(tuple, got.collect())) == [(1, 1), (3, 1), (4, 1), (7, 1)]
    changed = words[:6] + ["иное"] + words[7:14]
    one = spark.createDataFrame([(8, " ".join(changed))], "doc_id long, text string")
    assert leakage.leaked_items(one, items).count() == 0
    assert leakage.leaked_items(one, items, edits=1, recall=0.999).count() == 1
    assert leakage.leaked_items(df.limit(0), items).count() == 0


@pytest.mark.parametrize("edits", [1, 2])
@pytest.mark.parametrize("bound", [leakage.BROADCAST_WINDOWS, 0])
def test_recall_with_edits(spark, edits, bound):
    rng = random.Random(edits)
    vocabulary = [f"слово{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice((7, 9, 14, 30))))) for i in range(40)]
    docs = []
    for d in range(160):
        i, t = rng.choice(items)
        w = t.split()
        at = rng.randint(0, max(0, len(w) - 12))
        w = w[at : at + 12]
        for _ in range(rng.randint(0, edits)):
            p = rng.randrange(len(w))
            w[p : p + 1] = rng.choice(([rng.choice(vocabulary)], [w[p], rng.choice(vocabulary)], []))
        docs.append((d, " ".join(rng.choices(vocabulary, k=20) + w + rng.choices(vocabulary, k=20))))
    want = leakage.exact_pairs(docs, items, 12, edits)
    d, t = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = set(map(tuple, leakage.leaked_items(d, t, edits=edits, recall=0.95, broadcast_windows=bound).collect()))
    assert got <= want and len(got) >= 0.93 * len(want) and len(want) > 60


def test_words_of_blocks():
    texts = [textwords.normal_words(x) for x in ("а б, в", "", "г", "б а")]
    w = leakage.Words(texts)
    assert [w.phrase(i, 1).decode() for i in range(6)] == list("абвгба") and list(w.doc) == [0, 0, 0, 2, 3, 3]
    assert w.hash[0] == w.hash[5] and w.hash[1] == w.hash[4] and len(set(w.hash)) == 4
    assert list(leakage.windows(w, 2)) == [0, 1, 4]


def test_rule_list():
    rng = np.random.default_rng(0)
    x = rng.random((600, 3))
    y = np.where(x[:, 0] > 0.8, "junk", np.where(x[:, 1] < 0.2, "list", "prose"))
    r = irep.fit(x[:400], y[:400], ["a", "b", "c"])
    assert (r.predict(x[400:], ["a", "b", "c"]) == y[400:]).mean() > 0.95
    assert irep.fit(np.zeros((0, 1)), np.array([]), ["a"]).rules == () and irep.fit(np.zeros((3, 1)), np.array(["p"] * 3), ["a"]).default == "p"


def test_statistics_and_kinds(spark):
    prose = "Мастер нашёл под лавкой старую карту, а потом ушёл домой. Ветер стих."
    listing = "\n".join(f"- слово{i}" for i in range(9))
    rows = [(i, prose + f" Раз {i}.") for i in range(40)] + [(100 + i, listing + f"\n- ещё{i}") for i in range(40)] + [(200, None), (201, ""), (202, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kind", F.lit("x"))
    labels = spark.createDataFrame([(i, "prose") for i in range(30)] + [(100 + i, "list") for i in range(25)] + [(None, "list"), (5, None)], "doc_id long, kind string")
    stats = {r.doc_id: r for r in quality.text_statistics(docs, ["а"]).collect()}
    assert stats[200].word_count == stats[201].word_count == 0 and stats[202].symbol_ratio == 0
    assert stats[0].word_count == 14 and stats[0].end_punct_share == 1.0 and stats[100].marked_line_share == 1.0
    got = {r.doc_id: r.kind for r in quality.document_kinds(docs, labels, leave_out="prose").collect()}
    assert got == {100 + i: "list" for i in range(40)}
    assert quality.document_kinds(docs, labels.limit(0)).count() == 0
