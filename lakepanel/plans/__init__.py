"""Layer plans: silver builders, gold marts, the state x month panel."""

from . import complaints, driver_views, lakehouse, loans, marts, medallion, panel

__all__ = ["complaints", "driver_views", "lakehouse", "loans", "marts", "medallion", "panel"]
