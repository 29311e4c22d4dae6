import gzip
import json

from pyspark.sql import functions as F

from lexloom.functions import native, rules
from lexloom.operators import articles, coverage, dedupe, forms, graph, quality
from lexloom.plans import pipeline, stages
from lexloom.runtime import Workspace
from lexloom.sinks import stardict
from lexloom.sources import books, lexemes, packs, wiki
from lexloom.sources.stardict import read_bundle


def column(spark, values, make):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(make(F.col("x"))).collect()]


def test_keys(spark):
    assert column(spark, ["  a‑b  c ", "й", None], native.normalize_key) == ["a-b c", "й", None]
    assert column(spark, ["-a", "", "слово", "123", "a" * 221, None], native.is_lookup_key) == [False, False, True, False, False, False]
    assert column(spark, ["ЁЛКА—Ель"], native.normalize_lookup) == ["елка-ель"]
    assert column(spark, ["руко́й"], lambda c: F.array_join(native.alias_candidates(c), ",")) == ["руко́й,рукой"]
    assert column(spark, ["é"], lambda c: F.array_join(native.alias_candidates(c, fast=True), ",")) == ["é"]
    assert column(spark, ["é"], lambda c: F.array_join(native.alias_candidates(c), ",")) == ["é,e"]


def test_tokens_and_scripts(spark):
    assert column(spark, ["Что-то, don't 5x", "", None], native.tokens) == [["Что-то", "don't", "5x"], [], []]
    assert column(spark, ["слово", "word", "λόγος", "sлово", "12", "字"], native.script_of) == [
        "cyrillic", "latin", "greek", "mixed", "numeric", "other-alphabet",
    ]
    assert column(spark, ["a b c"], lambda c: native.ngrams(native.tokens(c), 2, 4)) == [["a b", "b c", "a b c"]]


def test_write_semantics(spark):
    df = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), (None, "z", 3), ("b", None, 4)], "k string, v string, n int")
    assert {(r.k, r.v) for r in dedupe.insert_or_ignore(df, ["k"], ["n"]).collect()} == {("a", "y"), (None, "z"), ("b", None)}
    assert {(r.k, r.v) for r in dedupe.insert_or_replace(df, ["k"], ["n"]).collect()} == {("a", "x"), (None, "z"), ("b", None)}
    assert dedupe.insert_or_ignore(df.limit(0), ["k"], ["n"]).count() == 0
    s = spark.createDataFrame(
        [("a", "d1", "wiktionary:ru"), ("a", "d2", "dal"), ("a", "d3", "extra:t"), ("b", "d4", "dal")], "lemma string, definition string, source string"
    )
    assert {r.definition for r in dedupe.layer_fallback(s).collect()} == {"d1", "d3", "d4"}


def test_closure_and_pruning(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "x"), (None, "d"), ("", "d"), ("d", "d")], "key string, lemma string")
    d = spark.createDataFrame([("d", "t")], "lemma string, definition string")
    edges, defined = graph.clean_edges(e), graph.defined_lemmas(d)
    kept = graph.resolve_aliases(edges, defined, Workspace(spark, "t"))
    assert sorted((r.key, r.lemma) for r in kept.collect()) == [("a", "d"), ("b", "d"), ("c", "d"), ("d", "d")]


def test_long_chains_and_cycles_resolve(spark):
    chain = [(f"k{i}", f"k{i + 1}") for i in range(300)] + [("k7", "k3"), ("loop", "loop2"), ("loop2", "loop"), ("loop2", "k0")]
    edges = graph.clean_edges(spark.createDataFrame(chain, "key string, lemma string"))
    defined = spark.createDataFrame([("k300",)], "lemma string")
    got = graph.resolve_aliases(edges, defined, Workspace(spark, "t")).collect()
    assert sorted(r.key for r in got) == sorted([f"k{i}" for i in range(300)] + ["loop", "loop2"]) and {r.lemma for r in got} == {"k300"}
    none = graph.resolve_aliases(edges.limit(0), defined, Workspace(spark, "t"))
    assert none.count() == 0


def test_articles_and_offsets(spark):
    s = spark.createDataFrame(
        [("a", "Один.", 2), ("a", "один", 3), ("a", "Два", 1), ("b", "  ", 4), ("c", "Ё", 5), (None, "x", 6)], "lemma string, definition string, seq long"
    )
    a = articles.build_articles(s)
    assert {r.lemma: r.article for r in a.collect()} == {"a": "1. Два\n2. Один.", "c": "Ё"}
    size = F.octet_length("article").cast("long")
    for n in (1, 5):
        rows = articles.with_offsets(a, "lemma", size, n).orderBy("lemma").collect()
        assert [(r["offset"], r["size"]) for r in rows] == [(0, 22), (22, 2)]


def test_coverage(spark):
    docs = spark.createDataFrame([(1, "alpha beta alpha", "q"), (2, "известно-слово", "q"), (3, None, "q"), (4, "", "q")], "doc_id long, text string, doc string")
    keys = spark.createDataFrame([("alpha",), ("alpha beta",), ("слово",), (None,)], "k string")
    report, by_file, unknown = pipeline.coverage_of(docs.drop("doc"), keys, "k")
    assert report.first().asDict() == {
        "tokens_total": 4, "unique_tokens": 3, "known_tokens": 3, "unknown_tokens": 1, "coverage_percent": 75.0,
    }
    assert {r.doc: r.unknown_tokens for r in by_file.collect()} == {1: 0, 2: 1}
    assert [(r.normalized, r.category) for r in unknown.collect()] == [("известно-слово", "word")]
    none = coverage.token_counts(docs.limit(0), coverage.known_keys(keys, "k"), Workspace(spark, "t"), per_doc=False)
    assert coverage.coverage_report(none).first().coverage_percent == 100.0


def test_classify(spark):
    rows = [("xiv", "XIV"), ("аааа", "аааа"), ("сссp", "СССp"), ("ссср", "СССР"), ("word", "word"), ("иван", "Иван"), ("г-л-ава", "г-л-ава"), ("дом", "дом")]
    u = spark.createDataFrame([(n, 1) for n, _ in rows], "normalized string, count long")
    v = spark.createDataFrame([(n, 1, t, 1) for n, t in rows], "normalized string, rank int, token string, n long")
    got = {r.normalized: (r.category, r.candidate_key) for r in coverage.classify(u, v).collect()}
    assert got["xiv"] == ("number", "roman:14") and got["аааа"][0] == "noise" and got["ссср"][0] == "abbreviation"
    assert got["сссp"][0] == "foreign" and got["иван"][0] == "name" and got["г-л-ава"][0] == "noise" and got["дом"][0] == "word"


def test_quality(spark):
    cases = [
        ("дом", "", "x"), ("дом", "Дом — это здание для жилья людей.", "x"), ("x", "См. другое слово", "x"), ("x", "Город в", "x"),
        ("x", "Смотри https://a.b текст длинный", "x"), ("x", "Рассеянность \"", "x"), ("x", "<b>Дом</b> для жилья", "x"), ("x", "Женское имя", "x"), ("x", None, None),
    ]
    s = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "seq long, lemma string, definition string, source string")
    rows = {r.seq: r for r in quality.score(quality.with_flags(s)).collect()}
    want = {0: "empty", 2: "redirect_residue", 3: "fragment", 4: "url_residue", 5: "bad_residue", 6: "markup_residue", 7: "onomastic_stub", 8: "empty"}
    assert all(f in rows[n].flags for n, f in want.items())
    assert rows[0].score == 0 and rows[7].score == 64 and rows[8].score == 0
    assert quality.review_queue(quality.score(quality.with_flags(s)), 3).count() == 3


def test_rules():
    c = rules.clean_definition
    assert c("[[дом|строение]] для {{помета|жилья}} людей;") == "Строение для людей"
    assert c("Пишется <и> — <э>") == "Пишется <и> — <э>" and c("<b>дом</b>") == "Дом"
    assert c("Страд. прич. прош. вр. от вкопать") == "" and rules.form_target("Страд. прич. прош. вр. от вкопать") == "вкопать"
    assert c("мат. функция") == "Функция" and c("?") == "" and c(None) == ""
    for t in ("мат. функция", "a [[b|c]] d", "1. Слово; "):
        assert c(c(t)) == c(t)
    assert rules.form_variants("слова^△, слово два, 12") == ["слова", "слово два"]
    assert rules.typographic_variants("s'il plaît") == ["s'il plait", "s’il plait", "s’il plaît"]
    assert rules.without_latin_accents("ёй é") == "ёй e"
    assert rules.clean_gloss("a <i>thing</i> ◆ example") == "a thing" and rules.clean_gloss("форма слова") == ""
    lead = "'''Рис''' (лат. ''Oryza'') — род однолетних и многолетних [[трава|травянистых]] растений. Ещё."
    assert rules.wiki_lead("Рис (растение)", lead) == "Род однолетних и многолетних травянистых растений."


def test_lexemes(spark, tmp_path):
    records = [
        {"word": "дом", "lang_code": "ru", "senses": [{"glosses": ["здание"]}, {"glosses": "жильё"}], "forms": [{"form": "дома^△"}, {"form": "dom", "tags": ["romanization"]}]},
        {"word": "вкопан", "lang_code": "ru", "senses": [{"glosses": ["Страд. прич. прош. вр. от вкопать"]}]},
        {"word": "x", "lang_code": "fr", "senses": [{"glosses": ["y"]}]},
        {"title": "Википедия:А", "redirect": "дом", "pos": "hard-redirect"},
        {"title": "домы", "redirect": "дом", "pos": "hard-redirect"},
    ]
    path = tmp_path / "d.jsonl.gz"
    path.write_bytes(gzip.compress(("\n".join(json.dumps(r, ensure_ascii=False, separators=(",", ":")) for r in records) + "\n{broken\n").encode()))
    rows = lexemes.read_entries(spark, str(path))
    assert {(r.lemma, r.definition) for r in lexemes.senses_of(rows).collect()} == {("дом", "Здание"), ("дом", "Жильё")}
    assert {(r.key, r.lemma) for r in lexemes.links_of(rows).collect()} == {("дом", "дом"), ("дома", "дом"), ("вкопан", "вкопать"), ("домы", "дом")}
    assert [(r.key, r.target) for r in lexemes.hints_of(rows).collect()] == [("вкопан", "вкопать")]
    entity = {"language": "Q7737", "lemmas": {"ru": {"value": "лес"}}, "senses": {"S1": {"glosses": {"ru": {"value": "роща"}}}}, "forms": [{"representations": {"ru": {"value": "леса"}}}]}
    other = tmp_path / "e.json"
    other.write_text("[\n" + json.dumps(entity, ensure_ascii=False) + ",\n]\n", encoding="utf-8")
    rows = lexemes.read_entities(spark, str(other))
    assert {(r.key, r.lemma) for r in lexemes.links_of(rows).collect()} == {("лес", "лес"), ("леса", "лес")}


def test_wiki_packs_books(spark, tmp_path):
    (tmp_path / "w.xml").write_text(
        "<mediawiki><page><title>Рис</title><ns>0</ns><revision><text bytes='9'>'''Рис''' — травянистое растение для еды людей.\n"
        "== История ==\nx [[Категория:Ботаника]]</text></revision></page><page><title>Т</title><ns>0</ns><redirect title='Рис'/>"
        "<revision><text bytes='1'>#x</text></revision></page></mediawiki>", encoding="utf-8",
    )
    c = wiki.prepare_candidates(wiki.read_pages(spark, str(tmp_path / "w.xml")))
    assert [(r.title, r.categories) for r in c.collect()] == [("Рис", "Ботаника")]
    assert [r.definition for r in wiki.lead_definitions(c).collect()] == ["Травянистое растение для еды людей."]
    (tmp_path / "p.tsv").write_text("mot\tслово\tmôt\n# c\nbad\n", encoding="utf-8")
    entries = packs.read_pack(spark, str(tmp_path / "p.tsv")).where("reason is null").select("word", "definition", "aliases")
    senses, links = packs.store_rows(packs.with_variants(entries), "pack:p")
    assert [(r.lemma, r.definition) for r in senses.collect()] == [("mot", "Слово")]
    assert {r.key for r in links.collect()} == {"mot", "môt"} 
    (tmp_path / "x.jsonl").write_text('{"word":"a","definitions":["b","c"]}\n{"word":"d","definition":"e"}\nnope\n')
    assert {(r.word, r.definition) for r in packs.read_extra_json(spark, str(tmp_path / "x.jsonl")).collect()} == {("a", "b"), ("a", "c"), ("d", "e")}
    assert books.book_text("a.fb2", "<FictionBook><description>m</description><body><p>Текст</p></body><binary>zz</binary></FictionBook>".encode()).strip() == "Текст"
    assert books.book_text("a.txt.gz", gzip.compress(b"\xef\xbb\xbfabc")) == "abc"


def test_forms(spark):
    hints = spark.createDataFrame([("вкопан", "вкопать", "passive"), ("a", None, "passive"), ("b", "c", "form-of")], "key string, target string, kind string")
    senses = spark.createDataFrame([("вкопать", "Копать и зарыть что-либо в землю.")], "lemma string, definition string")
    links = spark.createDataFrame([("копанный", "копать"), ("зарытый", "зарыть"), ("зарытая", "зарыть")], "key string, lemma string")
    assert [(r.key, r.definition) for r in forms.derive_overrides(hints, senses, links).collect()] == [("вкопан", "Копанный и зарытый в землю.")]


def test_bundle_round_trip(spark, tmp_path):
    senses = spark.createDataFrame([("дом", "Здание", "s", 1), ("дом", "Жильё", "s", 2), ("лес", "Роща", "s", 3)], "lemma string, definition string, source string, seq long")
    links = spark.createDataFrame([("дома", "дом"), ("дома", "лес"), ("ж" * 128, "лес"), ("нет", "нигде")], "key string, lemma string")
    hints = spark.createDataFrame([], "key string, target string, kind string")
    base = str(tmp_path / "d")
    stats = pipeline.build_dictionary(spark, senses, links, hints, base, "t")
    assert stats["wordcount"] == 3 and stats["articles"] == 3
    entries, synonyms = read_bundle(spark, base)
    assert synonyms.count() == 0
    got = {r.word: r.article for r in entries.collect()}
    assert got == {"дом": "1. Здание\n2. Жильё", "лес": "Роща", "дома": "1. Здание\n2. Жильё\nРоща"}
    assert stardict.parse_synonyms(b"a\0\0\0\0\1b\0\0") == [("a", 1)]


def test_stage_cache(spark, tmp_path):
    cache, calls = stages.StageCache(spark, str(tmp_path)), []

    def make():
        calls.append(1)
        return spark.range(3)

    for sig in ("s1", "s1", "s2"):
        assert cache.get("x", stages.signature({"v": sig}), make).count() == 3
    assert len(calls) == 2


def test_streaming(spark, tmp_path):
    from lexloom.streaming.coverage import token_windows

    rows = spark.sql("select timestamp'2024-01-01 10:00' as loaded_at, 'a b a' as text union all select null, 'c'")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = token_windows(stream).writeStream.outputMode("complete").format("memory").queryName("tw").start()
    q.processAllAvailable()
    q.stop()
    assert {(r.normalized, r.n) for r in spark.table("tw").collect()} == {("a", 2), ("b", 1)}
