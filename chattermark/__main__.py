"""Run a whole analysis as a job: `python -m chattermark --help`."""

from __future__ import annotations

import argparse

from chattermark import settings
from chattermark.plans.report import run_analysis, run_catalog_analysis
from chattermark.session import build_session
from chattermark.settings import AnalysisSettings
from chattermark.sources.tables import from_parquet


def parse(args: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="chattermark", description=__doc__)
    parser.add_argument("--tables", help="folder of Parquet tables; the catalog if left out")
    parser.add_argument("--prefix", default="", help="prefix of catalog table names")
    # Fixed values: --start-date, --end-date, --threshold, --output-dir and --no-text-analysis
    # are the options users of such an analysis know.
    parser.add_argument("--start-date", default=settings.DEFAULT_START, help="YYYY-MM-DD")
    parser.add_argument("--end-date", default=settings.DEFAULT_END, help="YYYY-MM-DD, exclusive")
    parser.add_argument("--period-format", default=settings.DEFAULT_PERIOD_FORMAT)
    parser.add_argument("--threshold", type=int, default=settings.DEFAULT_THRESHOLD)
    parser.add_argument("--peak-grain", choices=("video", "channel"), default="video")
    parser.add_argument("--output-dir", required=True)
    parser.add_argument("--no-text-analysis", action="store_true")
    return parser.parse_args(args)


def main(args: list[str] | None = None) -> dict[str, str]:
    given = parse(args)
    options = AnalysisSettings(
        start=given.start_date,
        end=given.end_date,
        period_format=given.period_format,
        threshold=given.threshold,
        peak_grain=given.peak_grain,
    )
    spark = build_session()
    rest = {"options": options, "include_texts": not given.no_text_analysis}
    if given.tables:
        result = run_analysis(from_parquet(spark, given.tables), given.output_dir, **rest)
    else:
        result = run_catalog_analysis(spark, given.output_dir, given.prefix, **rest)
    for name, path in sorted(result.files.items()):
        print(f"{name}\t{path}")
    return result.files


if __name__ == "__main__":
    main()
