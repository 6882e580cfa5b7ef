"""File-stream intake."""
