"""Command line: parse files into documents, list formats and tools."""

import argparse
import sys

from millrace import __version__

TOOLS = {"parse": "ingest"}


def arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace")
    top.add_argument("--version", action="version", version=__version__)
    sub = top.add_subparsers(dest="command")
    p = sub.add_parser("parse", help="files to blocks")
    p.add_argument("-f", "--file")
    p.add_argument("-d", "-i", "--input")
    p.add_argument("--no-recursive", action="store_true")
    p.add_argument("-o", "--output")
    p.add_argument("--format", choices=["auto", "json", "jsonl"], default="auto")
    p.add_argument("--engine", choices=["auto", "paddle", "easyocr", "tesseract"], default="auto")
    p.add_argument("--lang")
    p.add_argument("--strategy", choices=["auto", "text", "ocr"], default="auto")
    p.add_argument("--no-clean", action="store_true")
    p.add_argument("--cleaners")
    p.add_argument("--min-chars", type=int, default=2)
    p.add_argument("--merge-threshold", type=int, default=80)
    p.add_argument("--boilerplate-ratio", type=float, default=0.35)
    p.add_argument("--list-formats", action="store_true")
    p.add_argument("--fail-fast", action="store_true")
    stages = sub.add_parser("list", help="tools")
    stages.add_argument("--stage")
    sub.add_parser("stages", help="stages")
    return top


def main(argv: list[str] | None = None) -> int:
    """Exit code: 1 for wrong use, no files or a write error; 2 for failures with --fail-fast, after the whole batch."""
    args = arguments().parse_args(argv)
    if args.command == "list":
        print("\n".join(t for t, s in TOOLS.items() if args.stage in (None, s)))
        return 0
    if args.command == "stages":
        print("\n".join(sorted(set(TOOLS.values()))))
        return 0
    if args.command != "parse":
        arguments().print_usage(sys.stderr)
        return 1
    from millrace.sources import formats

    if args.list_formats:
        print("\n".join(formats.supported_extensions()))
        return 0
    paths = [p for p in (args.file, args.input) if p]
    if not paths:
        print("give -f or -d", file=sys.stderr)
        return 1
    return _parse(args, paths)


def _parse(args: argparse.Namespace, paths: list[str]) -> int:
    from functools import reduce

    from pyspark.sql import DataFrame, SparkSession

    from millrace import sinks
    from millrace.operators import clean, verdict
    from millrace.plans.corpus import parse
    from millrace.sources import formats

    spark = SparkSession.builder.appName("millrace").getOrCreate()
    try:
        files = reduce(DataFrame.unionByName, (formats.scan(spark, p, not args.no_recursive) for p in paths))
        if files.isEmpty():
            raise FileNotFoundError("no files")
    except Exception as e:  # whatever the file system says
        print(f"no files: {str(e).splitlines()[0]}", file=sys.stderr)
        return 1
    parsed = parse(files)
    sections, docs = parsed.sections, parsed.documents
    if not args.no_clean:
        opts = clean.Options(min_chars=args.min_chars, merge_threshold=args.merge_threshold, boilerplate_ratio=args.boilerplate_ratio)
        docs = docs.join(clean.cleaning_stats(sections, opts, args.cleaners), "source_id", "left")
        sections = clean.clean(sections, opts, args.cleaners)
    nested = sinks.nested(verdict.verdicts(docs, sections), sections)
    totals = sinks.summary(docs, parsed.failures).first()
    lines = args.format == "jsonl" or args.format == "auto" and totals.succeeded > 1
    out = sinks.as_json(nested).select("value") if lines or totals.succeeded == 1 else sinks.envelope(nested)
    if args.output:
        try:
            out.write.mode("overwrite").text(args.output)
        except Exception as e:
            print(f"can't write {args.output}: {str(e).splitlines()[0]}", file=sys.stderr)
            return 1
    else:
        for row in out.toLocalIterator():
            print(row.value)
    print(f"total {totals.total}, succeeded {totals.succeeded}, failed {totals.failed}", file=sys.stderr)
    for f in totals.failures:
        print(f"{f.source}: {f.kind}: {f.error}", file=sys.stderr)
    return 2 if args.fail_fast and totals.failed else 0


if __name__ == "__main__":
    sys.exit(main())
