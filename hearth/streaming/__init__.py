from .alerts import run_alerts  # noqa: F401
