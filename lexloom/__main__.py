"""Command line: ``python -m lexloom build|coverage|review|packs|report|extract|keys|validate``."""

from __future__ import annotations

import argparse
import json

from lexloom.runtime import Workspace, session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexloom")
    sub = p.add_subparsers(dest="action", required=True)
    b = sub.add_parser("build", help="write a dictionary bundle from senses, links and form_hints tables")
    b.add_argument("data_dir")
    b.add_argument("base", help="path of the bundle without suffix")
    b.add_argument("--title", default="lexloom")
    b.add_argument("--extras", help="folder of extra files, appended to the store")
    b.add_argument("--no-quality", action="store_true", help="leave out the quality pass")
    b.add_argument("--strict", action="store_true", help="fail if an article shows anything but meanings")
    for name, text in (("coverage", "coverage of books by a list of keys"), ("review", "tables of unknown words, grouped and ranked")):
        c = sub.add_parser(name, help=text)
        c.add_argument("books")
        c.add_argument("keys", nargs="+", help="text files with one key per line, or bundles (path of an .ifo file)")
        c.add_argument("--top", type=int, default=50)
        if name == "review":
            c.add_argument("--out", required=True, help="folder of the tables")
    k = sub.add_parser("packs", help="one bundle per pack of a pack_entries table, and a manifest")
    k.add_argument("data_dir")
    k.add_argument("out")
    r = sub.add_parser("report", help="quality report of a senses table")
    r.add_argument("data_dir")
    r.add_argument("out")
    e = sub.add_parser("extract", help="short glosses of a word-entry dump as a pack table")
    e.add_argument("dump")
    e.add_argument("out")
    e.add_argument("--languages", default="fr,de,la")
    e.add_argument("--most", type=int, default=3, help="glosses per word")
    v = sub.add_parser("validate", help="check a dictionary bundle")
    v.add_argument("base")
    v.add_argument("--strict", action="store_true")
    return p


def _keys(spark, names: list[str]):
    """Keys of text files and of bundles as one column ``value``."""
    from lexloom.sources.stardict import read_keys

    texts = [n for n in names if not n.endswith(".ifo")]
    bundles = [n[:-4] for n in names if n.endswith(".ifo")]
    out = read_keys(spark, bundles).withColumnRenamed("word", "value")
    return out.unionByName(spark.read.text(texts)) if texts else out


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = session()
    from lexloom.sources.tables import table

    if a.action == "validate":
        from lexloom.sinks.stardict import validate

        print(json.dumps(validate(spark, a.base, a.strict)))
    elif a.action == "build":
        from lexloom.plans import pipeline

        t = [table(spark, a.data_dir, n) for n in ("senses", "links", "form_hints")]
        print(json.dumps(pipeline.build_dictionary(spark, *t, a.base, a.title, extras=a.extras, quality=not a.no_quality, strict=a.strict)))
    elif a.action == "packs":
        from lexloom.sinks import reports

        print(json.dumps(reports.write_packs(table(spark, a.data_dir, "pack_entries"), a.out, Workspace(spark, "packs"))))
    elif a.action == "report":
        from lexloom.sinks import reports

        print(json.dumps(reports.quality_report(table(spark, a.data_dir, "senses"), a.out, Workspace(spark, "report"))))
    elif a.action == "extract":
        from lexloom.sinks import reports
        from lexloom.sources import lexemes

        reports.write_tsv(lexemes.extract_glosses(spark, a.dump, a.languages.split(","), a.most).select("word", "definition"), a.out)
    else:
        from lexloom.plans import pipeline
        from lexloom.sources.books import read_books

        books, keys = read_books(spark, a.books), _keys(spark, a.keys)
        if a.action == "review":
            from lexloom.sinks import reports

            reports.write_tsv(reports.candidate_table(pipeline.review_of(books, keys, "value")), a.out)
        else:
            report, _, unknown = pipeline.coverage_of(books, keys, "value")
            print(json.dumps(report.first().asDict()))
            for r in unknown.orderBy("count", ascending=False).limit(a.top).toLocalIterator():
                print(json.dumps(r.asDict(), ensure_ascii=False))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
