"""The store: quality pass, upgrade and rescue, layers, old dictionaries."""

from pyspark.sql import functions as F

from lexloom.operators import aliases, layers, semantic
from lexloom.operators.semantic import Store
from lexloom.runtime import Workspace

SENSES = "lemma string, definition string, source string, seq long"
LINKS = "key string, lemma string"


def store(spark, senses, links=()):
    own = [(r[0], r[0]) for r in senses if r[0]]
    return Store(spark.createDataFrame([(*r, i) for i, r in enumerate(senses, 1)], SENSES), spark.createDataFrame(own + list(links), LINKS).distinct())


def texts(s):
    return sorted((r.lemma, r.definition) for r in s.senses.collect())


def pairs(s):
    return {(r.key, r.lemma) for r in s.links.collect()}


def test_alias_formulas(spark):
    rows = [
        "То же, что BIOS", "см. также кот", "Вариант бдеющій", "Вариант кодирования данных", "вариант формы черепа у живого человека земли", "К прил. бледный",
        "То же, что BIOS набор микропрограмм", "Вариант названия индийского города Мумбаи", "См. лес и роща", "уменьш. к кот, кошка", "То же, что дом; здание для жилья", "текст", "", "к 12",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string").select("i", aliases.formula(F.col("t")).alias("f"))
    got = {r.i: (r.f.candidates, r.f.tail) if r.f else None for r in df.collect()}
    want = [
        (["BIOS"], ""), (["также кот"], ""), (["бдеющій"], ""), None, None, (["бледный"], ""), (["BIOS"], "набор микропрограмм"), (["Мумбаи"], ""),
        (["лес", "роща"], ""), (["кот", "кошка"], ""), (["дом"], "здание для жилья"), None, None, None,
    ]
    assert [got[i] for i in range(len(rows))] == want


def test_semantic_pass(spark):
    s = store(
        spark,
        [
            ("Европа", "Часть света.", "test"), ("Єѵрѡпа", "Европа", "wiktionary:cu"), ("Абаза", "Фамилия", "wiktionary:ru"), ("кот", "Домашнее животное с усами.", "wiktionary:ru"),
            ("котяра", "О коте", "wiktionary:ru"), ("кошак", "То же, что кот", "wiktionary:ru"), ("ёж", "То же, что колючий зверь из сказки", "wiktionary:ru"),
            ("дом", "Дом — жилое здание", "wiktionary:ru"), ("дом", "Жилое здание", "dal"), ("бѣс", "Бес (аналогично русскому слову бес)", "wiktionary:orv"), ("бѣс", "Нечистый дух в сказках и быту.", "wiktionary:ru"),
            ("пусто", "Гора в", "wiktionary:ru"), ("азбука ж", "Собрание букв одного языка.", "dal"), (None, "x", "y"), ("z", None, "y"),
        ],
        [("коте", "кот"), ("аз", "азбука ж")],
    )
    r = semantic.semantic_pass(s, Workspace(spark, "t"))
    got = texts(r.store)
    assert ("Европа", "Часть света.") in got and not any(lem in ("Єѵрѡпа", "котяра", "кошак", "пусто") for lem, _ in got)
    assert ("Абаза", "Фамилия") in got and ("ёж", "Колючий зверь из сказки") in got and ("азбука", "Собрание букв одного языка.") in got
    assert [d for lem, d in got if lem == "дом"] == ["Жилое здание"] and [d for lem, d in got if lem == "бѣс"] == ["Нечистый дух в сказках и быту."]
    assert {("Єѵрѡпа", "Европа"), ("котяра", "кот"), ("кошак", "кот"), ("азбука", "азбука"), ("аз", "азбука")} <= pairs(r.store)
    assert "пусто" in {x.lemma for x in r.rescue.collect()}
    stats = {x.name: x.n for x in semantic.pass_statistics(r).collect()}
    assert stats["textual_alias"] == 2 and stats["about_alias"] == 1 and stats["duplicate"] == 1 and stats["removed"] == 1 and stats["old_equivalence_duplicate"] == 1
    empty = Store(s.senses.limit(0), s.links.limit(0))
    assert semantic.semantic_pass(empty, Workspace(spark, "t")).store.senses.count() == 0


def test_upgrade_and_rescue(spark):
    good = "Хищное млекопитающее семейства псовых, которое живёт в лесах, степях и горах Европы."
    s = store(spark, [("волк", "Зверь", "wiktionary:ru"), ("лис", "Рыжий лесной зверь с хвостом, хитрый в сказках и баснях.", "wiktionary:ru"), ("ёж", "Зверь", "dal"), ("рысь", "(", "wiktionary:ru")])
    out, changed = semantic.upgrade(s, spark.createDataFrame([("волк", good), ("лис", good), ("ёж", good), ("рысь", good), (None, good), ("нет", good)], "key string, definition string"), Workspace(spark, "t"))
    assert [(r.definition) for r in changed.collect()] == [good] and dict(texts(out))["рысь"] == good
    pages = spark.createDataFrame([("барс", "барс", good), ("пума (зверь)", "пума", good), ("рысь (зверь)", "рысь", good), ("чиж", "чиж", "Птица")], "title string, base_title string, definition string")
    wanted = spark.createDataFrame([("барс",), ("пума",), ("рысь",), ("чиж",)], "lemma string")
    got = dict(texts(semantic.rescue(s, wanted, pages, Workspace(spark, "t"))))
    assert got["барс"] == good and got["рысь"] == good and "пума" not in got and "чиж" not in got


def test_layers(spark):
    s = store(spark, [("дом", "Здание для жилья.", "wiktionary:ru")], [("дома", "дом")])
    rows = spark.createDataFrame([("дом", "другое здание", "x", 1), ("лес", "роща", "x", 2), ("лес", "бор", "x", 3), ("-а", "y", "x", 4), ("пуст", "?", "x", 5), ("лес", "роща", "x", 6)], "lemma string, definition string, source string, place long")
    filled, fresh = layers.add_senses(s, rows, fallback=True)
    assert texts(filled) == [("дом", "Здание для жилья."), ("лес", "Роща")] and [r.seq for r in fresh.collect()] == [2]
    both, fresh = layers.add_senses(s, rows)
    assert texts(both) == [("дом", "Другое здание"), ("дом", "Здание для жилья."), ("лес", "Бор"), ("лес", "Роща")] and sorted(r.seq for r in fresh.collect()) == [2, 3, 4]
    entries = spark.createDataFrame([(0, "дом м.", "Дом м. строение"), (1, "азбука ж", "ж. собрание букв || пример"), (2, "азбука", "второе"), (3, "12", "x"), (4, "пусто", "?")], "idx_no long, word string, article string")
    syn = spark.createDataFrame([("хата", 0), ("буквы", 1), ("число", 3), ("ничто", 4)], "alias string, idx_no long")
    out, counts = layers.import_dictionary(s, entries, syn, "dal", old=True)
    assert texts(out) == [("азбука", "Собрание букв"), ("дом", "Здание для жилья.")]
    assert {("хата", "дом"), ("буквы", "азбука"), ("азбука", "азбука")} <= pairs(out) and not any(k in ("число", "ничто") for k, _ in pairs(out))
    assert counts.first().asDict() == {"source_entries": 5, "skipped_existing": 1, "rejected": 2}
    ent = [("sense", "лес", "Роща", "wikidata", 1, 0), ("link", "лес", "лес", None, 1, 1), ("link", "леса", "лес", None, 1, 2), ("sense", "леса", "Подмостки", "wikidata", 2, 0), ("link", "леса", "леса", None, 2, 1), ("sense", "дома", "Дома", "wikidata", 3, 0), ("link", "домами", "дома", None, 3, 1)]
    got = layers.import_entities(s, spark.createDataFrame(ent, "kind string, a string, b string, c string, file_pos long, item_pos int"))
    assert texts(got) == [("дом", "Здание для жилья."), ("лес", "Роща")] and ("домами", "дома") in pairs(got)


def test_pages(spark):
    lead = "'''{}''' — раздел науки, который изучает свойства тел и веществ."
    pages = [("Оптика", "Физика"), ("Список рек", "Физика"), ("Гром (группа)", "Музыка"), ("Иванов", "Физики\nРодившиеся в 1900"), ("Ложка", "Посуда"), ("А:б", "Физика"), (None, "Физика"), ("Нет", None)]
    df = spark.createDataFrame([(t, c, lead.format(t)) for t, c in pages], "title string, categories string, lead string")
    got = layers.page_definitions(df)
    assert [(r.title, r.definition) for r in got.collect()] == [("Оптика", "Раздел науки, который изучает свойства тел и веществ.")]
    s = store(spark, [("дом", "Здание для жилья.", "wiktionary:ru")])
    p = spark.createDataFrame([("Оптика (наука)", "Оптика", "Раздел науки о свете."), ("дом", "дом", "Иное здание.")], "title string, base_title string, definition string")
    out = layers.import_pages(s, p, Workspace(spark, "t"))
    assert texts(out) == [("Оптика (наука)", "Раздел науки о свете."), ("дом", "Здание для жилья.")] and ("Оптика", "Оптика (наука)") in pairs(out)


def test_about_phrases(spark):
    from lexloom.operators import about

    words = [("секс", ""), ("СССР", ""), ("мужской", ""), ("половой", ""), ("член", ""), ("низший", ""), ("слой", ""), ("население", ""), ("человек", ""), ("новая", ""), ("новый", ""), ("книга", "")]
    s = store(
        spark, [(w, "Толкование слова.", "wiktionary:ru") for w, _ in words],
        [("сексе", "секс"), ("мужском", "мужской"), ("половом", "половой"), ("члене", "член"), ("низших", "низший"), ("слоях", "слой"), ("населения", "население"), ("человеке", "человек"), ("новой", "новый"), ("книге", "книга")],
    )
    rows = ["О сексе в СССР", "О мужском половом члене", "О низших слоях населения", "О деятельном, неутомимом человеке", "О новой книге", "О неведомом человеке", "текст", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "seq int, text string")
    lemmas = s.senses.select("lemma").distinct()
    got = {r.seq: r.rewritten for r in about.rewrite(df, s.links, lemmas).collect()}
    assert got == {0: "Секс в СССР", 1: "Мужской половой член"}  # an ending -ой may be a noun's


def test_leaked_lines(spark):
    from lexloom.operators import leaks

    rows = [("a", "1. Здание.\n2. мат. функция"), ("b", "Пишется <и> — <э>"), ("c", "<b>x</b>"), ("d", "Прич. от расшить"), ("e", "Гора в"), ("f", "(в физике) сила"), ("g", "x ◆ y"), ("h", None), ("i", "")]
    got = leaks.leaked_lines(spark.createDataFrame(rows, "lemma string, article string")).collect()
    assert sorted((r.lemma, r.fault) for r in got) == [("a", "label"), ("c", "html"), ("d", "grammar"), ("e", "placeholder"), ("f", "context"), ("g", "residue")]
