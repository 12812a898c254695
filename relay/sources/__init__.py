"""Readers of topics, envelope files and Protobuf payloads."""
