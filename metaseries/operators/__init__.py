"""Operators over measurement series: pooling, deviation, tension, validation, comparison."""
