"""Small registries kept as JSON Lines: data sets, and validation sets. A change writes a new file and swaps it in."""

from __future__ import annotations

import json
import os
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DATASETS = "ko_name string, en_name string, url string, license string"
VALIDATIONS = "seq int, valid_type_index string, question string, options array<string>, reasoning_process string, answer string, n_options string, type string, oai_model string, update_at string"
# Fixed values.
VALIDATION_TYPES = ("stmt_analysis", "acc_principle", "fin_ratio", "fin_concept", "mkt_analysis", "invst_strategy")


class _Registry:
    schema = ""

    def __init__(self, path: str):
        self.path = Path(path)

    def rows(self) -> list[dict]:
        return [json.loads(x) for x in self.path.read_text(encoding="utf-8").splitlines() if x.strip()] if self.path.exists() else []

    def frame(self, spark: SparkSession) -> DataFrame:
        names = [x.split()[0] for x in self.schema.split(", ")]
        return spark.createDataFrame([tuple(r.get(k) for k in names) for r in self.rows()], self.schema)

    def _save(self, rows: list[dict]) -> None:
        new = self.path.with_suffix(".new")
        new.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows), encoding="utf-8")
        os.replace(new, self.path)


class DatasetRegister(_Registry):
    schema = DATASETS

    def add_config(self, ko_name: str, en_name: str, url: str, license: str, save: bool = True) -> list[dict]:
        rows = [*self.rows(), {"ko_name": ko_name, "en_name": en_name, "url": url, "license": license}]
        if save:
            self._save(rows)
        return rows

    def exclude_config(self, en_name: str, save: bool = True) -> list[dict]:
        rows = [r for r in self.rows() if r["en_name"] != en_name]
        if save:
            self._save(rows)
        return rows


class ValidationSetRegister(_Registry):
    schema = VALIDATIONS

    def add_validation(self, valid_type_index: str, question: str, options: list[str], reasoning_process: str, answer: str, type: str = "mcqa", oai_model: str = "", save: bool = True) -> list[dict]:
        if valid_type_index not in VALIDATION_TYPES:
            raise ValueError(f"unknown validation type {valid_type_index!r}")
        row = {"valid_type_index": valid_type_index, "question": question, "options": options, "reasoning_process": reasoning_process, "answer": answer, "n_options": str(len(options)), "type": type, "oai_model": oai_model, "update_at": date.today().isoformat()}
        rows = [{**r, "seq": i} for i, r in enumerate([*self.rows(), row])]
        if save:
            self._save(rows)
        return rows

    def exclude_config(self, seq: int, save: bool = True) -> list[dict]:
        rows = [{**r, "seq": i} for i, r in enumerate(r for r in self.rows() if r["seq"] != seq)]
        if save:
            self._save(rows)
        return rows
