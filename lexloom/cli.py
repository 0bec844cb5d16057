"""Commands: fetch, parse, collect and align."""

from __future__ import annotations

import argparse
import contextlib
import json
import os
import shutil
import sys
import uuid
import urllib.request
from pathlib import Path

from pyspark.sql import SparkSession

from .functions import alignment, inference, offsets
from .operators.decisions import FIELDS
from .plans import align, collect, markdown, sidetables, sinks
from .schema import RAW_ENTRY
from .sources import files, records, remote

BASE = "https://dumps.wikimedia.org/enwiktionary/"
ENTRIES, PAGES, SENSES = "entries.jsonl", "pages.xml.bz2", "senses.jsonl"
SIDE = ("off_page_translations", "wikidata_ids", "markup_index")


def option(text: str) -> tuple[str, object]:
    """name=value, the value as JSON if it is."""
    name, equals, value = text.partition("=")
    if not equals or not name:
        raise argparse.ArgumentTypeError(f"{text}: not name=value")
    try:
        return name, json.loads(value)
    except ValueError:
        return name, value


def temperature(text: str) -> float:
    if not 0 <= float(text) <= 2:
        raise argparse.ArgumentTypeError("not between 0 and 2")
    return float(text)


def positive(text: str) -> int:
    if int(text) < 1:
        raise argparse.ArgumentTypeError("not positive")
    return int(text)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lexloom")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str) -> argparse.ArgumentParser:
        own = commands.add_parser(name)
        own.add_argument("--dump-date", default="latest")
        own.add_argument("--cache-dir", type=Path, default=Path(os.path.expanduser("~/.cache/lexloom")))
        return own

    command("fetch")
    own = command("parse")
    own.add_argument("--entries", type=Path, help="JSON lines of an external parser")
    own.add_argument("--compression", choices=("gz", "bz2", "zst"))
    own = command("collect")
    own.add_argument("--pos", action="append")
    own.add_argument("--min-year", type=int)
    own.add_argument("--max-year", type=int)
    own.add_argument("--engine", default="forms", help="forms, or module:function that finds forms in a sentence")
    own.add_argument("--batch-size", type=positive, default=8)
    own.add_argument("--output-dir", type=Path, default=Path("senses"))
    own.add_argument("--compression", choices=("gz", "bz2", "zst"))
    own = command("align")
    own.add_argument("input", type=Path)
    own.add_argument("--task", action="append", choices=tuple(alignment.RELATIONS))
    own.add_argument("--synsets", type=Path)
    own.add_argument("--synset-source", action="append", default=[])
    own.add_argument("--model", default="stub", help="stub, or module:function that answers prompts")
    own.add_argument("--gloss-mode", choices=("full", "leaf"), default="full")
    own.add_argument("--prompts", type=Path)
    own.add_argument("--temperature", type=temperature, default=0.0)
    own.add_argument("--maximum-tokens", type=positive, default=4096)
    own.add_argument("--batch-size", type=positive, default=32_768)
    own.add_argument("--engine-option", type=option, action="append", default=[])
    own.add_argument("--reuse", type=Path)
    own.add_argument("--output-dir", type=Path, default=Path("alignment"))
    return top


def fetch(args: argparse.Namespace) -> None:
    def get(url: str) -> str | None:
        try:
            with urllib.request.urlopen(url, timeout=remote.READ_S) as response:
                return response.read().decode()
        except OSError:
            return None

    date = args.dump_date if args.dump_date != "latest" else remote.latest_date(get(BASE) or "", lambda d: get(f"{BASE}{d}/dumpstatus.json"))
    out = remote.dump_dir(args.cache_dir, date)
    out.mkdir(parents=True, exist_ok=True)
    if not (out / PAGES).exists():
        remote.download(f"{BASE}{date}/enwiktionary-{date}-pages-articles.xml.bz2", out / PAGES)


def parse(args: argparse.Namespace, spark: SparkSession) -> None:
    date = remote.fetched_date(args.cache_dir, args.dump_date)
    folder, resources = remote.dump_dir(args.cache_dir, date), remote.resource_dir(args.cache_dir, date)
    source = str(args.entries or files.existing(folder / ENTRIES) or _missing(folder / ENTRIES))
    entries = files.read_entries(spark, source)
    counts = files.line_counts(spark, source, RAW_ENTRY).first()
    if not counts.n_records:
        raise SystemExit("the parser's output has no entry")
    print(f"{counts.n_records} entries; skipped: {counts.n_other} other lines, {counts.n_broken} broken ones", file=sys.stderr)
    stored = folder / "pages.parquet"
    if not stored.exists():  # read three times below, so the XML is parsed once
        files.read_pages(spark, str(files.existing(folder / PAGES) or _missing(folder / PAGES))).write.parquet(str(stored))
    for name, found in sidetables.side_tables(spark.read.parquet(str(stored)), entries):
        if not (resources / name).exists():
            found.write.parquet(str(resources / name))


def _missing(path: Path) -> Path:
    raise SystemExit(f"{path} is missing; run the commands before this one")


def run_collect(args: argparse.Namespace, spark: SparkSession) -> None:
    if args.output_dir.is_file():
        raise SystemExit(f"{args.output_dir} is a file")
    if args.min_year and args.max_year and args.min_year > args.max_year:
        raise SystemExit("the least year is above the largest")
    date = remote.fetched_date(args.cache_dir, args.dump_date)
    folder, resources = remote.dump_dir(args.cache_dir, date), remote.resource_dir(args.cache_dir, date)
    entries = files.read_entries(spark, str(files.existing(folder / ENTRIES) or _missing(folder / ENTRIES)))
    try:
        locate = offsets.match_forms if args.engine == "forms" else inference.imported(args.engine)
    except (ImportError, AttributeError, ValueError) as error:
        raise SystemExit(f"no such engine: {args.engine}") from error
    side = {n: spark.read.parquet(str(resources / n)) if (resources / n).exists() else None for n in SIDE}
    lemmas = collect.collect(entries, args.pos, args.min_year, args.max_year, markup=side["markup_index"], wikidata=side["wikidata_ids"], off_page=side["off_page_translations"], locate=locate).persist()
    found = collect.statistics(lemmas)
    name = SENSES + (f".{args.compression}" if args.compression else "")
    with sinks.published(args.output_dir) as staging:
        sinks.writer_for(name)(collect.exported(lemmas), staging / name, "ord")
        sinks.write_json(found, staging / "report.json")
        (staging / "report.md").write_text(markdown.render(found), encoding="utf-8")
        settings = {"pos": args.pos, "min_year": args.min_year, "max_year": args.max_year, "engine": args.engine}
        sinks.write_json(markdown.collection_manifest(date, {n: n if side[n] is not None else None for n in SIDE}, settings, [name, "report.json", "report.md"]), staging / sinks.MANIFEST)
    lemmas.unpersist()


def run_align(args: argparse.Namespace, spark: SparkSession) -> None:
    if not args.input.exists():
        raise SystemExit(f"{args.input} is missing")
    if args.output_dir.is_file() or args.output_dir.resolve() in (args.input.resolve(), args.input.resolve().parent):
        raise SystemExit("the output must be a folder of its own")
    tasks = args.task or ["translations"]
    prompts = records.read_prompts(args.prompts) if args.prompts else None
    own = {"temperature": args.temperature, "maximum_tokens": args.maximum_tokens, **dict(args.engine_option)} if args.model != "stub" else {}
    try:
        model = inference.load(args.model, prompts, args.gloss_mode, own)
    except (ImportError, AttributeError, ValueError) as error:
        raise SystemExit(f"no such model: {args.model}") from error
    if "synsets" in tasks and args.synsets is None:
        raise SystemExit("--synsets is needed")
    lemmas = records.read_lemmas(spark, str(args.input))
    names = []
    # Beside the output, which executors write to as well.
    work = args.output_dir.resolve().parent / f".{args.output_dir.name}-{uuid.uuid4().hex}"
    work.mkdir(parents=True)
    with sinks.published(args.output_dir) as staging, contextlib.ExitStack() as after:
        after.callback(shutil.rmtree, work, ignore_errors=True)
        for task in tasks:
            cache = records.read_decisions(spark, str(args.reuse / f"{task}.tsv") if args.reuse else "")
            if task == "translations":
                queries = align.translation_queries(lemmas)
                align.decide(queries, cache, task, model, args.batch_size).write.parquet(f"{work}/{task}")
                decided = spark.read.parquet(f"{work}/{task}")
                lemmas = align.apply_translations(lemmas, queries, decided)
            else:
                lemmas, decided = align.align_stages(lemmas, records.read_synsets(spark, str(args.synsets)), args.synset_source, cache, str(work), model)
            rows = decided.orderBy("alignment_id", "source_id", "target_id").toLocalIterator()
            sinks.write_tsv((r.asDict() for r in rows), staging / f"{task}.tsv", FIELDS)
            (staging / "reports").mkdir(exist_ok=True)
            sinks.write_json(align.report(decided, task), staging / "reports" / f"{task}.json")
            names += [f"{task}.tsv", f"reports/{task}.json"]
        sinks.write_json_lines(collect.exported(lemmas), staging / SENSES, "ord" if "ord" in lemmas.columns else None)
        # What was used: the stub reads no prompt and has no options.
        settings = {"model": args.model} | ({"gloss_mode": args.gloss_mode, "batch_size": args.batch_size, **own} if args.model != "stub" else {})
        sinks.write_json(markdown.alignment_manifest(str(args.input), tasks, settings, "none" if args.model == "stub" else str(args.prompts or "default"), args.synset_source or None, [*names, SENSES]), staging / sinks.MANIFEST)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "fetch":
        fetch(args)
        return 0
    spark = SparkSession.builder.appName("lexloom").getOrCreate()
    {"parse": parse, "collect": run_collect, "align": run_align}[args.command](args, spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
