"""``spark-submit`` entry point: the batch from two exports to serving tables and chart data."""

from __future__ import annotations

import argparse

from membertide.operators.dedup import SEQ
from membertide.plans import daily
from membertide.plans.stages import STAGES, run_all
from membertide.schemas import ADJACENCIES, COMPAT, INTERACTION, THERAPIST
from membertide.session import build_session
from membertide.sources.readers import EXPORT_FORMATS, read_interactions, read_therapists, rejected_rows
from membertide.sources.writers import ingest_interactions, write_export


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="membertide", description=__doc__)
    parser.add_argument("therapists", help="path of the therapists export")
    parser.add_argument("interactions", help="path of the interactions export")
    parser.add_argument("root", help="shared folder for all outputs")
    parser.add_argument("version", help="name of the serving version to write")
    parser.add_argument("--previous", help="serving version to upsert into")
    parser.add_argument("--fresh", action="store_true", help="start serving tables anew beside published versions")
    parser.add_argument("--format", choices=EXPORT_FORMATS, default="csv")
    parser.add_argument("--sequence", help="BIGINT column that rises with row order")
    parser.add_argument("--multiline", action="store_true", help="JSON files hold one array each")
    parser.add_argument(
        "--lenient", action="store_true", help="wrong values become NULL; their rows are kept in ROOT/rejected"
    )
    parser.add_argument("--ingest", action="store_true", help="first rewrite the interactions as ROOT/ingested")
    parser.add_argument("--adjacency", choices=ADJACENCIES, default=COMPAT)
    parser.add_argument("--export-inputs", action="store_true", help="also write the counted rows")
    parser.add_argument("--files", type=int, help="part files per table of counted rows")
    parser.add_argument(
        "--daily", action="store_true", help="the interactions are new ones; merge them into ROOT/daily, from --previous to VERSION"
    )
    parser.add_argument("--stages", nargs="+", choices=STAGES, default=STAGES)
    args = parser.parse_args(argv)
    if args.daily and not args.sequence:
        parser.error("--daily needs --sequence, a column with one order over all runs")

    spark = build_session()
    how = {"fmt": args.format, "multiline": args.multiline}
    if args.lenient:
        for name, path, schema in (
            ("therapists", args.therapists, THERAPIST),
            ("interactions", args.interactions, INTERACTION),
        ):
            write_export(rejected_rows(spark, path, schema, **how), f"{args.root}/rejected/{name}", "json")
    how["lenient"] = args.lenient
    interactions = read_interactions(spark, args.interactions, sequence=args.sequence, clean=True, **how)
    if args.ingest:
        ingest_interactions(interactions, f"{args.root}/ingested")
        interactions = read_interactions(spark, f"{args.root}/ingested", "parquet", sequence=SEQ)
    therapists = read_therapists(spark, args.therapists, **how)
    if args.daily:
        daily.run(spark, interactions, therapists, f"{args.root}/daily", args.version, args.previous, args.adjacency)
        return
    run_all(
        spark,
        interactions,
        therapists,
        args.root,
        args.version,
        previous=args.previous,
        fresh=args.fresh,
        adjacency=args.adjacency,
        export_inputs=args.export_inputs,
        files=args.files,
        only=tuple(args.stages),
    )


if __name__ == "__main__":
    main()
