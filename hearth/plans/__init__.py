"""Query catalog: named DataFrame plans over the driver tables and their
DuckDB twins used as an independent check. Importing the package registers
every query in ``catalog.QUERIES`` / ``catalog.ORACLE_SQL``."""

from . import catalog  # noqa: F401
from . import q_prepare, q_profile, q_functions, q_models, q_oof, q_features  # noqa: F401,E402
from . import q_trees, q_explain, q_report, q_stream  # noqa: F401,E402
