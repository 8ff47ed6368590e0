"""DataFrame operators on samples, images and texture parts."""
