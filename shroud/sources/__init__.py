"""Sources and sinks (S1-S4) and the driver-table fixture view."""

from shroud.sources.fixture import (  # noqa: F401
    PERSON_COURSE_SQL, PERSON_COURSE_TEMPLATE, TABLES, person_course, register_tables,
)
from shroud.sources.io import (  # noqa: F401
    derive_mapping, export_csv, export_view, from_table, load_source, write_mapping,
)
