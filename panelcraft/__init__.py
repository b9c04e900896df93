"""panelcraft: entity-by-period risk panels on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` function usable with
``df.transform``; nothing pulls data through the driver.
"""

from panelcraft.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
