"""All oracle SQL, keyed like ``queries()``."""

from oraclesql import ar

ORACLE: dict[str, str] = {}
ORACLE.update(ar.Q)
from oraclesql import marts  # noqa: E402

ORACLE.update(marts.Q)
from oraclesql import measures as _measures  # noqa: E402

ORACLE.update(_measures.Q)
from oraclesql import staging as _staging  # noqa: E402

ORACLE.update(_staging.Q)
from oraclesql import quality as _quality  # noqa: E402

ORACLE.update(_quality.Q)
# marts over staged tables: the same definition
ORACLE.update({f"{m}_staged": ORACLE[m] for m in ("ar_bucket_summary", "payment_velocity", "customer_acquisition", "route_efficiency")})
