"""Path templates and the layer catalog.

Step paths are templates with ``{{ key }}`` placeholders: ``execution_date``,
``root``, ``name``, ``group``, ``format`` and ``extension``. Each batch lives
under a Hive-style ``dt=<date>`` directory so readers of a table root get
``dt`` as a partition column and Catalyst prunes to the dates asked for.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# File extension by format; table formats (snapshot, delta)
# are directories and get none.
EXTENSIONS = {"parquet": ".parquet", "csv": ".csv", "json": ".json"}


def check_date(execution_date: str) -> str:
    """The execution date as ``YYYY-MM-DD``; anything else raises, so every
    batch folder parses as a DATE partition value."""
    try:
        parsed = _dt.date.fromisoformat(execution_date)
    except (TypeError, ValueError) as err:
        raise ValueError(f"execution date must be YYYY-MM-DD, got {execution_date!r}") from err
    if parsed.isoformat() != execution_date:
        raise ValueError(f"execution date must be YYYY-MM-DD, got {execution_date!r}")
    return execution_date


def render_path(template: str, execution_date: str, **context: str) -> str:
    """Replace ``{{ key }}`` placeholders; ``extension`` follows ``format``."""
    rendered = template.replace("{{ execution_date }}", execution_date)
    for key, value in context.items():
        rendered = rendered.replace("{{ " + key + " }}", str(value))
    fmt = str(context.get("format", "")).lower()
    return rendered.replace("{{ extension }}", EXTENSIONS.get(fmt, ""))


def partition_dir(table_root: str, execution_date: str) -> str:
    return f"{table_root.rstrip('/')}/dt={execution_date}"


@dataclass(frozen=True)
class Lake:
    """Folder layout of one lake: a root with one folder per layer."""

    root: str

    def table(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    @property
    def quarantine_root(self) -> str:
        return f"{self.root.rstrip('/')}/quarantine"

    @property
    def meta_root(self) -> str:
        return f"{self.root.rstrip('/')}/_meta"

    def quarantine_path(self, execution_date: str, reason: str) -> str:
        reason = reason.replace(" ", "_")
        return f"{self.quarantine_root}/dt={execution_date}/reason={reason}"

    def paths(self, execution_date: str) -> dict[str, str]:
        """The nine named batch paths of one execution date."""
        d = execution_date
        return {
            "sales_landing": partition_dir(self.table("landing", "sales_erp"), d),
            "customers_landing": partition_dir(self.table("landing", "customers_crm"), d),
            "sales_bronze": partition_dir(self.table("bronze", "sales_erp"), d),
            "customers_bronze": partition_dir(self.table("bronze", "customers_crm"), d),
            "sales_silver": partition_dir(self.table("silver", "sales"), d),
            "customers_silver": partition_dir(self.table("silver", "customers"), d),
            "sales_summary": partition_dir(self.table("gold", "sales_summary"), d),
            "sales_quarantine": f"{self.quarantine_root}/dt={d}",
            "customers_quarantine": f"{self.quarantine_root}/dt={d}",
        }
