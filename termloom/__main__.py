"""Match a list of terms against a folder of text files."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from termloom.functions.text import ENGLISH, FIELDS
from termloom.plans.workflows import match_corpus


def main() -> None:
    parser = argparse.ArgumentParser(prog="termloom", description=__doc__)
    parser.add_argument("documents", help="folder with one document per .txt file")
    parser.add_argument("terms", help="file with one term per line")
    parser.add_argument("output", help="folder to append term,docid,hits lines to")
    parser.add_argument("--field", choices=FIELDS, default=ENGLISH, help="analysed form to match in")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("termloom").getOrCreate()
    match_corpus(spark, args.documents, args.terms, args.output, args.field)


if __name__ == "__main__":
    main()
