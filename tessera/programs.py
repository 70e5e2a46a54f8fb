"""Programs from files to files: `python -m tessera.programs partition|train|link|validate ...`.

Each returns its exit code: 0, or 1 if the validator has an issue. Paths may be files or folders.
"""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tessera.operators import validate as rules
from tessera.plans import pipeline
from tessera.sources import tables
from tessera.sources.shared import fresh

SOURCES = ("source1", "source2", "source3")
KEY, MATCHED, OFFERED = "source1_entity_id", "matched_entity_ids", "candidate_entity_ids"


def partition(spark: SparkSession, a: argparse.Namespace) -> int:
    """All three sources by country."""
    tables.write_partitioned({s: tables.read_records(spark, f"{a.in_dir}/{a.prefix}{s}.tsv", drop_short=True) for s in SOURCES}, a.part_dir)
    return 0


def train(spark: SparkSession, a: argparse.Namespace) -> int:
    """Fits on a seeded sample of the first source and a pool with all its true matches; stores the model and prints its metrics."""
    began = time.time()
    one, two, three = (tables.read_records(spark, f"{a.train_dir}/train_{s}.tsv") for s in SOURCES)
    s1 = tables.sample(one, a.sample, seed=a.seed) if a.sample else one
    truth = pipeline.truth_pairs(tables.read_truth(spark, f"{a.train_dir}/train_ground_truth.tsv"), s1)
    pool = pipeline.training_pool(two, three, truth, a.pool_sample, a.seed) if a.pool_sample else pipeline.pool_of(two, three)
    model, threshold, metrics = pipeline.train(pipeline.records(s1), pipeline.records(pool), truth, a.k, a.rounds, a.depth, a.seed)
    if model is None:
        print("no training pair, or of one class only: nothing to learn from", file=sys.stderr)
        return 1
    metrics |= {"feature_importance": {r["feature"]: r["importance"] for r in pipeline.feature_importance(spark, model).collect()}, "elapsed_sec": time.time() - began}
    pipeline.save_bundle(spark, model, threshold, metrics, a.model)
    print(json.dumps(metrics, indent=2))
    return 0


def _done(spark: SparkSession, path: str) -> DataFrame:
    """Keys of an earlier output; none if there is no output."""
    try:
        return tables.read_id_lists(spark, path).select("key")
    except AnalysisException:
        return spark.createDataFrame([], "key string")


def link(spark: SparkSession, a: argparse.Namespace) -> int:
    """Matches and candidates of all records of the first source, or of one country. With `resume` only for those that lack either."""
    slug = a.only_country or None
    s1 = pipeline.records(tables.read_pool(spark, a.part_dir, slug, SOURCES[:1]))
    pool = pipeline.records(tables.read_pool(spark, a.part_dir, slug, SOURCES[1:]))
    model, threshold = pipeline.load_bundle(spark, a.model)
    places = [(f"{a.out_dir}/matching_results.tsv", MATCHED), (f"{a.out_dir}/candidate_pairs.tsv", OFFERED)]
    done = [_done(spark, path) for path, _ in places] if a.resume else [None, None]
    if a.resume:
        s1 = pipeline.resume(s1, done[0].join(done[1], "key", "left_semi"))
    lists, kept = pipeline.link(s1, pool, model, threshold, a.k, index=a.index_dir or None), fresh(spark, "link")
    for rows, (_, name), old in zip(lists, places, done, strict=True):  # whole before an output changes, as these read the earlier ones
        (rows if old is None else rows.join(old, "key", "left_anti")).write.parquet(f"{kept}/{name}")
    for path, name in places:
        tables.write_id_lists(spark.read.schema("key string, ids array<string>").parquet(f"{kept}/{name}"), path, KEY, name, "append" if a.resume else "overwrite")
    return 0


def validate(spark: SparkSession, a: argparse.Namespace) -> int:
    """Prints PASS, or how many issues there are and the first ones; 1 if there is any."""
    s1, s2, s3 = (tables.read_records(spark, f"{a.test_dir}/test_{s}.tsv") for s in SOURCES)
    issues = rules.validate_files(spark, a.matching, a.candidate, s1, s2, s3).cache()
    verdict = rules.verdict(issues).first()
    if verdict["passed"]:
        print("PASS")
        return 0
    print(f"{verdict['n_issues']} issue(s) found:")
    for r in rules.report(issues).orderBy("file", "rule", "key", "detail").limit(a.show).collect():
        print(f"{r['severity']} {r['file']} {r['rule']}: {r['key']} {r['detail']}".rstrip())
    return 1


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tessera")
    sub = top.add_subparsers(dest="program", required=True)

    def program(run, **options):
        p = sub.add_parser(run.__name__, help=run.__doc__)
        p.set_defaults(run=run)
        for name, default in options.items():
            flag = f"--{name.replace('_', '-')}"
            if default is False:
                p.add_argument(flag, action="store_true")
            else:
                p.add_argument(flag, required=default is None, default=default, type=str if default is None else type(default))

    program(partition, in_dir=None, part_dir=None, prefix="test_")
    program(train, train_dir=None, model=None, sample=3000, pool_sample=150_000, k=15, rounds=200, depth=6, seed=42)
    program(link, part_dir=None, model=None, out_dir=None, k=15, only_country="", resume=False, index_dir="")
    program(validate, matching=None, candidate=None, test_dir=None, show=100)
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(arguments)
    return a.run(spark or SparkSession.builder.appName(f"tessera {a.program}").getOrCreate(), a)


if __name__ == "__main__":
    sys.exit(main())
