"""Where tables come from: a database, files, or frames."""

from lakeferry.sources.base import Source
from lakeferry.sources.files import FileSource
from lakeferry.sources.frames import FrameSource
from lakeferry.sources.jdbc import JdbcSource, mysql_url

__all__ = ["FileSource", "FrameSource", "JdbcSource", "Source", "mysql_url"]
