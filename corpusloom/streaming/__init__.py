"""The stateless operators over streams."""
