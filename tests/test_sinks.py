"""Reports, packs, extra files, extraction, archives and the bundle reader."""

import gzip
import io
import json
import struct
import tarfile

import pytest

from lexloom.operators.semantic import Store
from lexloom.runtime import Workspace
from lexloom.sinks import reports, stardict
from lexloom.sources import lexemes, packs, rejects
from lexloom.sources.stardict import article_text, read_bundle, read_keys, unpack_archive

SENSES = "lemma string, definition string, source string, seq long"


def test_quality_report(spark, tmp_path):
    s = spark.createDataFrame([("дом", "Жилое здание для людей.", "a", 1), ("x", "Город в", "b", 2), ("y", "Женское имя", None, 3), (None, None, "b", 4)], SENSES)
    r = reports.quality_report(s, f"file://{tmp_path}/q", Workspace(spark, "t"))
    assert r["totals"]["definitions"] == 4 and r["flags"]["fragment"] == 1 and r["flags"]["empty"] == 1
    assert json.loads((tmp_path / "q/report.json").read_text()) == json.loads(json.dumps(r))
    assert spark.read.option("sep", "\t").option("header", True).csv(f"file://{tmp_path}/q/review").count() == 2
    info = reports.build_info(spark, f"file://{tmp_path}/b", ["x", "old", ""], {"n": 1}, retired=("old",))
    assert info == {"sources": ["x"]} and json.loads((tmp_path / "b/BUILD_STATS.json").read_text()) == {"n": 1}


def test_packs_and_bundle_reader(spark, tmp_path):
    e = spark.createDataFrame([("mot", "слово", ["môt"], "French phrases"), ("Wort", "слово", None, "German-Phrases"), ("x", None, [], "French phrases"), (None, "y", [], "z"), ("q", "w", [], None)], "word string, definition string, aliases array<string>, pack string")
    m = reports.write_packs(e, f"file://{tmp_path}", Workspace(spark, "t"))
    assert sorted(m) == ["french_phrases", "german_phrases"] and m["french_phrases"]["wordcount"] == 2
    base = f"file://{tmp_path}/french_phrases/french_phrases"
    assert stardict.validate(spark, base) == {"keys": 2, "articles": 1}
    assert {(r.word, r.article) for r in read_bundle(spark, base)[0].collect()} == {("mot", "Слово"), ("môt", "Слово")}
    assert {r.word for r in read_keys(spark, [base, f"file://{tmp_path}/german_phrases/german_phrases"]).collect()} >= {"mot", "môt", "Wort"}
    data = (tmp_path / "french_phrases/french_phrases.idx").read_bytes()
    (tmp_path / "french_phrases/french_phrases.idx").write_bytes(data[:-1] + b"\xff")
    (tmp_path / "french_phrases/.french_phrases.idx.crc").unlink()
    with pytest.raises(ValueError):
        stardict.validate(spark, base)


def test_archive_and_synonyms(spark, tmp_path):
    art = "<b>Дом</b> &amp; двор".encode()
    files = {
        "d/a.ifo": b"StarDict's dict ifo file\nversion=2.4.2\nsametypesequence=m\n", "d/a.idx.gz": gzip.compress("дом".encode() + b"\0" + struct.pack(">II", 0, len(art)) + b"\xff\0" + struct.pack(">II", 0, 1)),
        "d/a.dict.dz": gzip.compress(art), "d/a.syn": "хата".encode() + b"\0\0\0\0\0" + b"cut", "../evil.sh": b"x",
    }
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as t:
        for n, b in files.items():
            i = tarfile.TarInfo(n)
            i.size = len(b)
            t.addfile(i, io.BytesIO(b))
    base = unpack_archive(spark, f"file://{tmp_path}/a.tar.gz", f"file://{tmp_path}/u")
    entries, syn = read_bundle(spark, base, strict=False)
    assert [(r.word, " ".join(r.article.split())) for r in entries.collect()] == [("дом", "Дом & двор")]
    assert [(r.alias, r.idx_no) for r in syn.collect()] == [("хата", 0)] and not (tmp_path / "evil.sh").exists()
    assert article_text(b"a < b\0", "m") == "a < b"


def test_extras(spark, tmp_path):
    (tmp_path / "b.tsv").write_text("﻿# c\nдом\tЗдание\tхата|изба\nлес\tРоща\nлес\tРоща\tбор\n", encoding="utf-8")
    (tmp_path / "a.jsonl").write_text('{"word": "дом", "definitions": ["Здание", "Очаг"], "aliases": ["кров"]}\n{bad\n', encoding="utf-8")
    (tmp_path / "c.txt").write_text("x")
    found = packs.discover_extras(spark, f"file://{tmp_path}")
    assert [f.rsplit("/", 1)[1] for f in found] == ["a.jsonl", "b.tsv"]
    empty = Store(spark.createDataFrame([("дом", "Здание", "x", 1)], SENSES), spark.createDataFrame([("дом", "дом")], "key string, lemma string"))
    out = packs.import_extra(packs.import_extra(empty, found[0]), found[1])
    assert sorted((r.lemma, r.definition, r.source) for r in out.senses.collect()) == [("дом", "Здание", "x"), ("дом", "Очаг", "extra:a.jsonl"), ("лес", "Роща", "extra:b.tsv")]
    keys = {(r.key, r.lemma) for r in out.links.collect()}
    assert ("кров", "дом") in keys and ("хата", "дом") not in keys and ("бор", "лес") in keys


def test_extract_glosses(spark, tmp_path):
    rows = [
        {"word": "mot", "lang_code": "fr", "senses": [{"glosses": ["слово"]}, {"glosses": ["слово"]}, {"glosses": ["речь"]}, {"glosses": ["см."]}, {"glosses": ["x"], "tags": ["form-of"]}]},
        {"word": "mot", "lang_code": "en", "senses": [{"glosses": ["y"]}]},
    ]
    (tmp_path / "d.jsonl").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows) + "\n{", encoding="utf-8")
    got = lexemes.extract_glosses(spark, f"file://{tmp_path}/d.jsonl", ["fr"], 2)
    assert sorted((r.word, r.place, r.definition) for r in got.collect()) == [("mot", 1, "слово"), ("mot", 2, "речь")]


def test_a_line_on_its_own():
    for line in ('"a', 'a\t"b', '"a"b\tc', "a", "a\tb", 'a\t"b""c"'):
        assert list(rejects.parse_lines([(7, line)])) == [7]


def test_artifacts(spark, tmp_path):
    from lexloom.plans.stages import Artifacts

    (tmp_path / "out").mkdir()
    (tmp_path / "out/a.txt").write_text("1")
    kept = Artifacts(spark, f"file://{tmp_path}/kept")
    assert not kept.restore("x", "s", f"file://{tmp_path}/back") and kept.restore_latest("x", f"file://{tmp_path}/back") is None
    kept.save("x", "s", f"file://{tmp_path}/out")
    assert kept.restore("x", "s", f"file://{tmp_path}/back") and (tmp_path / "back/a.txt").read_text() == "1"
    assert kept.restore_latest("x", f"file://{tmp_path}/again") == "s" and not kept.restore("x", "other", f"file://{tmp_path}/back")


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    from lexloom import __main__ as cli

    monkeypatch.setattr(cli, "session", lambda: spark)
    d = f"file://{tmp_path}/d"
    spark.createDataFrame([("дом", "Дом — жилое здание", "wiktionary:ru", 1), ("хата", "То же, что дом", "wiktionary:ru", 2)], SENSES).write.parquet(f"{d}/senses.parquet")
    spark.createDataFrame([("дома", "дом")], "key string, lemma string").write.parquet(f"{d}/links.parquet")
    spark.createDataFrame([], "key string, target string, kind string").write.parquet(f"{d}/form_hints.parquet")
    (tmp_path / "x").mkdir()
    (tmp_path / "x/t.tsv").write_text("лес\tРоща\tбор\n", encoding="utf-8")
    assert cli.main(["build", d, f"file://{tmp_path}/b", "--extras", f"file://{tmp_path}/x", "--strict"]) == 0
    assert {(r.word, r.article) for r in read_bundle(spark, f"file://{tmp_path}/b")[0].collect()} == {
        ("дом", "Жилое здание"), ("дома", "Жилое здание"), ("хата", "Жилое здание"), ("лес", "Роща"), ("бор", "Роща")
    }
    (tmp_path / "book.txt").write_text("дом лес река река", encoding="utf-8")
    assert cli.main(["coverage", f"file://{tmp_path}/book.txt", f"file://{tmp_path}/b.ifo"]) == 0
    assert '"unknown_tokens": 2' in capsys.readouterr().out
    assert cli.main(["review", f"file://{tmp_path}/book.txt", f"file://{tmp_path}/b.ifo", "--out", f"file://{tmp_path}/review"]) == 0
    assert [r.candidate_key for r in spark.read.option("sep", "\t").option("header", True).csv(f"file://{tmp_path}/review").collect()] == ["река"]
