"""Write PLANS.md: the physical operator trees of the key plans (sf0.01).

Usage: ``python tools/plans_doc.py [sf_dir]``. Builds a small lake from the
driver's tables in the checkpoint folder, then prints each plan's operator
tree (the first part of ``explain("formatted")``, AQE's initial plan) and
the scan details that matter (pushed and partition filters, read schema).
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree_and_scans(text: str) -> str:
    tree = text.split("\n\n\n")[0].replace("== Physical Plan ==\n", "")
    keep = [ln for ln in text.splitlines()
            if ln.startswith(("PushedFilters", "PartitionFilters", "ReadSchema", "DataFilters"))]
    return tree.rstrip() + ("\n\n" + "\n".join(keep) if keep else "")


def main(argv: list[str]) -> None:
    from touchline import schemas
    from touchline.operators import gold, silver, views
    from touchline.operators.model import match_features
    from touchline.plans.jobs import only_partitions
    from touchline.plans.queries import REGISTRY, _landed_run, _silver
    from touchline.sources.bronze import bronze_from_landing
    from touchline.sources.landing import landed_headers
    from touchline.session import build_session, scratch_path
    from touchline.sources.layers import layer_path, read_table, write_layer

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", app_name="touchline-plans", shuffle_partitions=8)
    root = scratch_path(spark, "plans-lake")
    write_layer(silver.conform_bronze(REGISTRY["raw_matches"](spark, sf_dir)), layer_path(root, "bronze.matches"))
    write_layer(_silver(spark, sf_dir), layer_path(root, "silver.matches"))
    run_root, run_id = _landed_run(spark, sf_dir)
    bronze, matches = read_table(spark, root, "bronze.matches"), read_table(spark, root, "silver.matches")
    plans = [
        ("Silver job: bronze table -> silver (no shuffle; key filter at the scan)", silver.silver_matches(bronze)),
        ("Gold job, one pass: per-(team, venue) aggregates", gold.team_venue_aggregates(matches)),
        ("Team table, standalone: one scan, Generate, one Exchange", gold.team_season_table(matches)),
        ("League summary, standalone", gold.league_season_summary(matches)),
        ("Flagship: champions (WindowGroupLimit under the rank filter)", views.champions(gold.team_season_table(matches))),
        ("Pruned read: one league of silver", matches.where("league_code = 'E0'")),
        ("Incremental silver job (dynamic overwrite): only the landed partitions are read",
         silver.silver_matches(only_partitions(bronze, [("E0", "9900")]))),
        ("Model features: the season bound prunes the season folders", match_features(matches, 1998)),
        ("File heads of a landed run (names and lengths listed, no data scan)", landed_headers(spark, run_root)),
        ("Bronze from landed files: one positional scan met by the file dimension",
         bronze_from_landing(spark, run_root, run_id).select("league_code", "season", "HomeTeam", "extra_columns")),
        ("Landing check (manifest vs landed files)", REGISTRY["landing_results"](spark, sf_dir)),
    ]
    out = ["# PLANS", "",
           "Physical operator trees of the key plans, generated by `python tools/plans_doc.py` on sf0.01 tables",
           "(AQE's initial plans; at run time AQE coalesces partitions and may switch small joins to broadcast).",
           "Lake tables are read with their fixed schemas; see README \"Scale design\" for the reasoning.", ""]
    for title, df in plans:
        out += [f"## {title}", "", "```", tree_and_scans(formatted(df)), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
