from quillstat.sources.readers import (  # noqa: F401
    TABLES, read_csv, read_table, load_testdata, strip_headers, normalise_missing,
    infer_types, prepare_input, type_decisions,
)
