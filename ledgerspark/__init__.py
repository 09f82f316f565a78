"""ledgerspark: cost and operational-risk analytics as Spark DataFrame operators.

Every public operator is a pure function ``DataFrame(s) -> DataFrame``; nothing
is collected to the driver on a data path. See ``README.md`` for the map from
operator keys to modules.
"""

from ledgerspark.session import build_session, shared_folder

__all__ = ["build_session", "shared_folder"]
