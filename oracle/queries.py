"""Oracle SQL per registered query name."""

from __future__ import annotations

from oracle.models import CTES, OPS_SQL, REPORT_SQL, model, with_ctes

# the 27 warehouse models (staging, core, marts), each its own query
MODEL_NAMES = [n for n in CTES if n.startswith(("stg_", "dim_", "fct_", "mart_")) and not n.endswith("_changed")]

ORACLE: dict[str, str] = {name: model(name) for name in MODEL_NAMES}

ORACLE.update({name: with_ctes(sql) for name, sql in REPORT_SQL.items()})
ORACLE.update({name: with_ctes(sql) for name, sql in OPS_SQL.items()})

from hublytics.plans import catalog as _cat  # noqa: E402
from oracle import quality as _quality  # noqa: E402

ORACLE.update(_quality.build(_cat.fixture_checks, _cat.FIXTURE_GATE, _cat.FIXTURE_YEARS, _cat.AS_OF,
                             _cat.DELIVERED_REASON_ERROR_AFTER))
