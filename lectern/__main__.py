"""Command line over a folder of corpus files.

    python -m lectern ask NODES "question" [--k 5]
    python -m lectern build NODES OUT
    python -m lectern refs OUT "John 1:14" | --article "ST I, q.2, a.3" | --top
    python -m lectern check NODES

NODES is a glob of JSON-lines nodes; OUT is the folder ``build`` writes.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from .functions.refs import citation_to_id, first_key, normalize_ref
from .functions.text import snippet
from .operators.retrieve import search
from .plans.build import build_graph, export_graph, validate_articles
from .session import build_session
from .sources.readers import scan_jsonl, scan_jsonl_filtered


# Fixed value: citing articles listed by name.
CITERS_SHOWN = 15


def show(df, most: int | None = None) -> None:
    """Rows as lines of text, as they arrive; all of them unless ``most`` is a report's length."""
    print(" | ".join(df.columns))
    for row in (df.limit(most) if most else df).toLocalIterator():
        print(" | ".join("" if v is None else str(v) for v in row))


def main() -> None:
    ap = argparse.ArgumentParser(prog="lectern", description="Cited answers from a text corpus, or a refusal.")
    sub = ap.add_subparsers(dest="command", required=True)
    ask = sub.add_parser("ask")
    ask.add_argument("nodes")
    ask.add_argument("question")
    ask.add_argument("--k", type=int, default=5)
    build = sub.add_parser("build")
    build.add_argument("nodes")
    build.add_argument("out")
    refs = sub.add_parser("refs")
    refs.add_argument("out")
    refs.add_argument("reference", nargs="?")
    refs.add_argument("--article")
    refs.add_argument("--top", action="store_true")
    check = sub.add_parser("check")
    check.add_argument("nodes")
    args = ap.parse_args()
    spark = build_session()
    table = lambda name: spark.read.parquet(f"{args.out}/{name}")

    if args.command == "ask":
        nodes = scan_jsonl_filtered(spark, args.nodes)
        words = F.concat_ws(" ", F.coalesce("title", F.lit("")), "text")
        found = search(nodes, args.question, args.k, "id", words, ("citation", "title", "text")).cache()
        if found.isEmpty():
            print(f'The corpus does not contain a clear answer to: "{args.question}"')
        else:
            show(found.orderBy(F.desc("score"), "id").select("citation", "title", snippet(F.col("text")).alias("passage")))
    elif args.command == "build":
        export_graph(build_graph(scan_jsonl(spark, args.nodes), args.out), f"{args.out}/json")
    elif args.command == "check":
        show(validate_articles(scan_jsonl(spark, args.nodes)))
    elif args.top:
        for name in ("books", "verses", "articles", "stats"):
            show(table(name), 12)
    elif args.article:
        wanted = F.coalesce(citation_to_id(F.lit(args.article)), F.lit(args.article))
        show(table("refs").filter(F.col("id") == wanted))
        show(table("edges").filter(F.col("src") == wanted).select("dst_citation"))
        citing = table("edges").filter(F.col("dst") == wanted)
        show(citing.orderBy("src").select("src_citation", "src_title"), CITERS_SHOWN)
        if (more := citing.count() - CITERS_SHOWN) > 0:
            print(f"and {more} more")
    else:
        key = first_key(normalize_ref(F.lit(args.reference)))
        show(table("index").filter(F.col("key") == key).orderBy("id").select("citation", "title", "ref"))


if __name__ == "__main__":
    main()
