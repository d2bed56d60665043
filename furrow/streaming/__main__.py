"""``python -m furrow.streaming [--fanout]``: run the scoring stream until one of its queries ends or fails."""

import sys

from furrow.config import JobConfig
from furrow.session import build_session
from furrow.streaming.jobs import run_stream


def main() -> None:
    spark = build_session("furrow-scoring")
    run_stream(spark, JobConfig.from_env(), fanout="--fanout" in sys.argv[1:])
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
