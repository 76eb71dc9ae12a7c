from panelflume.sources.files import (read_csv, read_json, read_optional, shared_folder, write_csv, write_json,
                                      write_results)
from panelflume.sources.lookups import values_sql, values_table
from panelflume.sources.star import PANEL_SCHEMA, panel, table
