"""License notices looked for by default (fixed values: the wording of public licenses).

None contains another, so what a text is said to contain does not depend on which are asked for.
Licenses that differ in a name or a version alone are told apart by notices short enough that the
difference decides.
"""

NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "mit": "Released under the MIT License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met"
    ),
    "mit-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,"
        " INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR"
        " PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE"
        " FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
        " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
        " DEALINGS IN THE SOFTWARE."
    ),
    "bsd-warranty": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS"
        " OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF"
        " MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "bsd-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to"
        " endorse or promote products derived from this software without specific prior written"
        " permission."
    ),
    "apache-2.0-terms": (
        "you may not use this file except in compliance with the License. You may obtain a copy of"
        " the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "apache-2.0-title": (
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND"
        " CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"
    ),
    "gnu-gpl": "under the terms of the GNU General Public License",
    "gnu-lgpl": "under the terms of the GNU Lesser General Public License",
    "gnu-agpl": "under the terms of the GNU Affero General Public License",
    "gnu-2.0-or-later": "either version 2 of the License, or (at your option) any later version",
    "gnu-2.1-or-later": "either version 2.1 of the License, or (at your option) any later version",
    "gnu-3.0-or-later": "either version 3 of the License, or (at your option) any later version",
    "gnu-title": (
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but"
        " changing it is not allowed."
    ),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "cc-by-nc-4.0-international": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
        " copy of the MPL was not distributed with this file, You can obtain one at"
        " http://mozilla.org/MPL/2.0/."
    ),
    "epl-2.0": (
        "This program and the accompanying materials are made available under the terms of the"
        " Eclipse Public License 2.0"
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this permission"
        " notice appear in all copies."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will"
        " the authors be held liable for any damages arising from the use of this software. Permission"
        " is granted to anyone to use this software for any purpose, including commercial"
        " applications, and to alter it and redistribute it freely"
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to"
        " copy, modify, publish, use, compile, sell, or distribute this software, either in source"
        " code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any"
        " means."
    ),
    "bsl-1.0": "Distributed under the Boost Software License, Version 1.0.",
}
