from lakeshore.sources.tables import read_table, driver_table  # noqa: F401
