"""Run every layer from the environment: ``spark-submit touchline/__main__.py`` or ``python -m touchline [run_id]``.

Parameters are the ``TOUCHLINE_*`` variables of ``params.params_from_env``
(``TOUCHLINE_DATABASE_PREFIX`` names the catalog's databases,
``TOUCHLINE_TRAIN_MODEL`` is ``on`` or ``off``).
"""

from __future__ import annotations

import sys

from touchline.params import params_from_env
from touchline.plans.jobs import run_all
from touchline.session import build_session


def main(argv: list[str]) -> int:
    spark = build_session()
    report = run_all(spark, params_from_env(spark), argv[1] if len(argv) > 1 else None)
    print(report)
    return 0 if report.outputs else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
