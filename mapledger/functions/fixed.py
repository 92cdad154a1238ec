"""Fixed values of the published service and its file formats."""

# File extensions by the way they can be shown.
CONTAINER_EXTENSIONS = ("gpkg", "parquet", "fgb", "gml", "kml", "kmz", "zip")
RASTER_EXTENSIONS = ("tif", "tiff", "geotiff", "png", "jpg", "jpeg")
VECTOR_EXTENSIONS = ("geojson", "shp")
STYLE_EXTENSIONS = ("sld", "qml", "qlr", "lyr", "lyrx")
TABLE_EXTENSIONS = ("csv", "tsv", "txt", "xls", "xlsx", "ods")
EXTENSION_ALIASES = {"geoparquet": "parquet", "flatgeobuf": "fgb", "json": "geojson"}

# What a source must offer for a file-only dataset to count as spatial or openable.
SPATIAL_SOURCE_TYPES = ("govmap", "scraper")
SPATIAL_SOURCE_FORMATS = ("geojson", "kml", "kmz", "gpkg", "gml", "zip", "shp")
OPENABLE_SOURCE_FORMATS = tuple(
    dict.fromkeys(
        SPATIAL_SOURCE_FORMATS + CONTAINER_EXTENSIONS + RASTER_EXTENSIONS + VECTOR_EXTENSIONS + TABLE_EXTENSIONS
    )
)

# Catalog defaults. Caps are the service's own; operators cut only where a caller names a number.
DEFAULT_SCHEMA = "idx"
GATEWAY_SOURCE_TYPE = "ckan"
NO_NAME = "—"
DEFAULT_DISPLAY_MODE = 2
ORGANIZATION_CAP = 2000
LISTING_PAGE_SIZE = 500
SEARCH_LIMIT = 25
SHORTEST_SEARCH = 2

# Row caps of the service's routes.
DEFAULT_ROW_CAP = 50_000
FREE_QUERY_CAP = 1_000

# Geometry column, GeoJSON alias and helper columns without attributes.
GEOMETRY_COLUMN = "geom"
GEOJSON_COLUMN = "_geojson"
GEOMETRY_HELPER_COLUMNS = ("geom", "_geojson", "geometry_wkt")
HIDDEN_QUERY_COLUMNS = ("geom", "geometry_wkt")
GEOMETRY_TYPES = ("Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon")
DEFAULT_GEOMETRY_TYPE = "MultiPolygon"

# Names a style may use without the data publishing them.
PSEUDO_FIELDS = ("shape", "shape_area", "shape_length", "geometry", "the_geom")

# Patterns of addresses, file names and style documents.
BUCKET_PATTERN = r"https://pub-[0-9a-z]+\.r2\.dev/datasets/([0-9a-fA-F-]{36})/v[0-9]+/([^/?|]+)"
BUCKET_TAIL_PATTERN = r"https://pub-[0-9a-z]+\.r2\.dev/datasets/([0-9a-fA-F-]{36}/v[0-9]+/[^/?|]+)"
HASH_PATTERN = r"\A[0-9a-fA-F]+_(?=.)"
UUID_PATTERN = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
PROPERTY_PATTERN = r"<(?:ogc:)?PropertyName>([^<]+)</(?:ogc:)?PropertyName>"
STYLE_ATTRIBUTE_PATTERN = r'(?:attr|fieldName)="([^"]+)"'
ABSOLUTE_ADDRESS_PATTERN = r"(?:[A-Za-z]:|/|https?://|file:)"

# Status words and messages of the refresh report.
UPDATE, CURRENT, MISSING, ERROR = "update", "current", "missing", "error"
ERROR_MESSAGE = "לא ניתן לקרוא את גרסאות המאגר"
MISSING_MESSAGE = "המשאב אינו קיים בגרסה האחרונה"
LOST_FILTER_NOTE = " (הסינון לא הוחל מחדש — ייתכן ששם השדה השתנה)"
REPORT_COLUMNS = (
    "layer", "dataset", "status", "from_version", "from_detected", "to_version", "to_detected",
    "rows_before", "rows_after", "renamed_fields", "result",
)

# Words of an SQL filter that name no field.
FILTER_KEYWORDS = (
    "ALL", "AND", "ANY", "AS", "ASC", "BETWEEN", "CASE", "CAST", "COLLATE", "CURRENT_CATALOG", "CURRENT_DATE",
    "CURRENT_ROLE", "CURRENT_SCHEMA", "CURRENT_TIME", "CURRENT_TIMESTAMP", "CURRENT_USER", "DATE", "DESC", "DISTINCT", "ELSE",
    "END", "ESCAPE", "EXISTS", "FALSE", "ILIKE", "IN", "INTERVAL", "IS", "ISNULL", "LIKE", "LOCALTIME", "LOCALTIMESTAMP", "NOT",
    "NOTNULL", "NULL", "OR", "REGEXP", "SESSION_USER", "SIMILAR", "SYMMETRIC", "THEN", "TIME", "TIMESTAMP", "TO", "TRUE",
    "UNKNOWN", "WHEN",
)

# Outcomes of matching a style bundle to a layer.
STYLED, STYLED_LYR, ALIASES = "styled", "styled_lyr", "aliases"
NO_BUNDLE, SKIPPED, NEEDS_SLYR = "none", "skipped", "needs_slyr"
