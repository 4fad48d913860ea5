"""Incremental ingestion: run the daily load for each raw file that arrives."""

from flightmart.streaming.file_trigger import start_file_loader

__all__ = ["start_file_loader"]
