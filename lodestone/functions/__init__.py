from lodestone.functions.cleansing import (  # noqa: F401
    convert_date,
    convert_null,
    convert_sign,
    decimal_chain,
    java_trim,
    register_sql_functions,
    to_timestamp_text,
)
