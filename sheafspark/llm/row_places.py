"""Where a row of a stored table lies: a name for it that every later scan gives again."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafspark.storage import written_table


def placed(table: DataFrame) -> tuple[DataFrame, Column]:
    """The table and the place of its rows: the file and the number in the file.

    Neither depends on how a scan splits the files, so the places of two scans meet even where executors came or went in
    between. Anything but a selection from a stored Parquet table is stored first.
    """
    try:
        return table, _place(table)
    except AnalysisException:
        table = written_table(table, "placed")
        return table, _place(table)


def _place(table: DataFrame) -> Column:
    file = table.metadataColumn("_metadata")
    place = F.struct(file["file_path"].alias("file"), file["row_index"].alias("row"))
    table.select(place)
    return place
