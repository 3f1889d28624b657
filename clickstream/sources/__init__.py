from clickstream.sources.tables import read_table, behaviour_events
from clickstream.sources.files import read_log, read_log_stream
from clickstream.sources.access_log import format_access_line, parse_access_log

__all__ = ["read_table", "behaviour_events", "read_log", "read_log_stream",
           "format_access_line", "parse_access_log"]
