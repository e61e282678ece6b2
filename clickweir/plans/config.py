"""Where the tables of a deployment live, and in which format."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Layout:
    """Paths under one root, each of which may be set on its own."""

    root: str
    fmt: str = "parquet"
    bronze: str = ""
    dead_letter: str = ""
    silver: str = ""
    quarantine: str = ""
    kpis: str = ""
    sessions: str = ""
    funnels: str = ""
    anomalies: str = ""
    alerts: str = ""
    checkpoints: str = ""
    alert_fmt: str = "json"
    alert_options: dict = field(default_factory=dict)
    panes: str = ""
    trends: str = ""
    trend_alerts: str = ""

    # Folder of each table below the root.
    _FOLDERS = {
        "bronze": "bronze/events_raw",
        "dead_letter": "bronze/dead_letter",
        "silver": "silver/events_clean",
        "quarantine": "silver/quarantine",
        "kpis": "gold/kpis",
        "panes": "gold/kpi_panes",
        "sessions": "gold/sessions",
        "funnels": "gold/funnels",
        "anomalies": "gold/anomalies",
        "trends": "gold/trends",
        "alerts": "alerts/anomaly_alerts",
        "trend_alerts": "alerts/trend_alerts",
        "checkpoints": "checkpoints",
    }

    def __post_init__(self):
        for name, folder in self._FOLDERS.items():
            if not getattr(self, name):
                object.__setattr__(self, name, f"{self.root.rstrip('/')}/{folder}")
