"""Column expressions (all JVM-side except the Jaro UDF)."""

from rollmatch.functions.address import STREET_ABBREVIATIONS, standardize_address  # noqa: F401
from rollmatch.functions.aun import (  # noqa: F401
    AUN_PATTERN,
    MEAL_FILE_AUN,
    UPLOAD_FILE_AUN,
    aun_from_filename,
    format_aun,
    numeric_aun,
    plain_aun,
    valid_aun,
)
from rollmatch.functions.jaro import jaro, jaro_below, jaro_similarity  # noqa: F401
from rollmatch.functions.nulls import count_where, distinct_with_null, strict_sum  # noqa: F401
from rollmatch.functions.text import (  # noqa: F401
    NA_TEXT,
    blank_or_null,
    clean_text,
    decodable_or_null,
    na_as_text,
    paste_key,
    present,
    trim_ws,
)
