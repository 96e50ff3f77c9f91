"""A small invented catalogue in the shapes that the parsers read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE = """| seq | name | translation | version |
| --- | --- | --- | --- |
| 1 | 🎯 Alder Fever | 桤木热 | 2.2025 |
| 2 | 🎯Birch Cough | 桦木咳 | 1.2026 |
| 3 | ✅ Cedar Ache: Upper | 雪松痛 | 3.2025 |
| 4 | Dogwood Rash/Itch | 山茱萸疹 | 1.2025 |
| 5 | Elm Ménage Syndrome (Late) | 榆树 综合征 | 4.2025 ||"""
LINKED = """| seq | name | version | remark |
| --- | --- | --- | --- |
| 1 | [Alder Fever](https://guides.example/a?category=1&id=901) | 2.2025 | 桤木 热 |
| 2 | [Birch Cough](https://guides.example/b?category=1&id=902) | 1.2026 | 桦木咳嗽 |
| 3 | [Cedar Ache: Upper](https://guides.example/c?category=1&id=903) | 1.2023 | 雪松痛 |
| 4 | [Dogwood Rash/Itch](https://guides.example/d?category=1&id=904) | 1.2025 | 山茱萸疹 |
| 5 | [Fir [Grand] Chill](https://guides.example/f?category=1&id=906) | 2.2026 | 冷杉 |"""
BLOCKS = """[Alder Fever](https://guides.example/a?category=1&id=901)

 Version: 2.2025 

[Fir [Grand] Chill](https://guides.example/f?category=1&id=906)

 Version: 2.2026 
"""
SUMMARY = """Total of 5:
- **Trees with leaves**：3
- **Conifers**：2"""


def lines(spark: SparkSession, text: str, whole: bool = False) -> DataFrame:
    return spark.createDataFrame([(x,) for x in ([text] if whole else text.split("\n"))], "value string")
