"""Sources and sinks: line, JSON-lines and CSV readers, prediction sink, test adapter."""

from rateflow.sources.csv_ratings import drop_header, parse_rating_lines, training_rows, val_frame
from rateflow.sources.inputs import Inputs, inputs_from_folder
from rateflow.sources.json_lines import parse_json_lines
from rateflow.sources.sink import prediction_frame, write_predictions
from rateflow.sources.tables import inputs_from_tables
from rateflow.sources.text import first_line, read_lines

__all__ = [
    "Inputs", "drop_header", "first_line", "inputs_from_folder", "inputs_from_tables",
    "parse_json_lines", "parse_rating_lines", "prediction_frame", "read_lines",
    "training_rows", "val_frame", "write_predictions",
]
