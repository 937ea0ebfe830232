"""``python -m tidemill JOB ...``: run a batch job or a stream (see :mod:`tidemill.jobs`)."""

from __future__ import annotations

import sys

from tidemill import jobs
from tidemill.session import build_session


def _options(arguments: list[str]) -> tuple[list[str], str | None, bool]:
    """Plain arguments, the folder after ``--out``, and whether ``--once`` was given."""
    plain, out, once = [], None, False
    rest = iter(arguments)
    for argument in rest:
        if argument == "--out":
            out = next(rest, None)
        elif argument == "--once":
            once = True
        else:
            plain.append(argument)
    return plain, out, once


def main(arguments: list[str]) -> int:
    plain, out, once = _options(arguments)
    name = plain.pop(0) if plain else ""
    batch, stream = jobs.BATCHES.get(name), jobs.STREAMS.get(name)
    right = batch and (len(plain) >= len(batch.paths) if batch.more else len(plain) == len(batch.paths))
    if not right and not (stream and len(plain) == 3):
        print(jobs.usage(), file=sys.stderr)
        return 2
    spark = build_session(f"tidemill {name}")
    if batch:
        jobs.run_batch(spark, name, plain, out)
    else:
        jobs.start_stream(spark, name, plain, once).awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
