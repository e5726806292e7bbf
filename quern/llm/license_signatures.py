"""Signatures of license texts, notices, badges and metadata, written by hand: label, pattern, priority, confidence.

A pattern is of words joined by single spaces, A-Z lower-cased and without marks. Priorities: 0 text of a license that no other
has, 1 its notice in files or its title, 2 text that related licenses share, 3 badges and metadata, 5 a bare name, 6 hints.
"""

SIGNATURES = [
    # permissive texts
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", 0, 0.98),
    ("mit", "to use copy modify merge publish distribute sublicense and or sell copies of the software", 0, 0.97),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 0, 0.96),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise", 1, 0.9),
    ("mit", "the mit license mit", 1, 0.95),
    ("mit", "mit license copyright c", 1, 0.95),
    ("mit-0", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided", 0, 0.98),
    ("x11", "except as contained in this notice the name of the x consortium shall not be used in advertising", 0, 0.98),
    ("x11", "x window system is a trademark of x consortium", 0, 0.95),
    ("x11", "except as contained in this notice the names? of .{0,60}? shall not be used in advertising or otherwise to promote the sale", 2, 0.85),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 0, 0.98),
    ("isc", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice", 0, 0.97),
    ("isc", "the author disclaims all warranties with regard to this software including all implied warranties of merchantability", 2, 0.8),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is", 0, 0.98),
    ("0bsd", "(?:bsd zero clause|zero clause bsd|0 ?bsd|free public license 1 0 0)", 1, 0.9),
    ("bsd-3-clause", "neither the name of .{0,80}? nor the names of its contributors may be used to endorse", 0, 0.95),
    ("bsd-3-clause", "neither the names? of the copyright holders? nor the names of (?:its|their) contributors may be used", 0, 0.96),
    ("bsd-3-clause", "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission", 0, 0.93),
    ("bsd-3-clause", "neither the name of the university nor the names of its contributors", 0, 0.95),
    ("bsd-3-clause-clear", "no express or implied licenses to any party s patent rights are granted by this license", 0, 0.97),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display", 0, 0.97),
    ("bsd-4-clause", "this product includes software developed by the university of california berkeley and its contributors", 0, 0.95),
    ("bsd-2-clause", "redistribution and use in source and binary forms with or without modification are permitted", 2, 0.8),
    ("bsd-2-clause", "the views and conclusions contained in the software and documentation are those of the authors and should not be interpreted", 0, 0.9),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions", 2, 0.75),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions", 2, 0.75),
    ("bsd", "this software is provided by the (?:copyright holders and contributors|regents and contributors|author) as is and any express or implied warranties", 2, 0.75),
    ("bsd-patent", "bsd 2 clause plus patent license", 1, 0.95),
    ("bsd-source-code", "redistributions of source code must retain the copyright notices as they appear in each source code file", 0, 0.95),
    ("zlib", "the origin of this software must not be misrepresented", 0, 0.95),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", 0, 0.96),
    ("zlib", "in no event will the authors be held liable for any damages arising from the use of this software", 1, 0.9),
    ("libpng", "this copy of the libpng notices is provided for your convenience", 0, 0.98),
    ("libpng", "png reference library license version 2", 1, 0.95),
    ("bsl-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", 0, 0.98),
    ("bsl-1", "boost software license version 1 0 august 17th 2003", 0, 0.99),
    ("bsl-1", "must be included in all copies of the software in whole or in part and all derivative works of the software unless such copies or derivative works are solely in the form of machine executable object code", 0, 0.97),
    ("ncsa", "university of illinois (?:ncsa )?open source license", 1, 0.95),
    ("ncsa", "neither the names of .{0,80}? nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", 1, 0.85),
    ("unlicense", "this is free and unencumbered software released into the public domain", 0, 0.98),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary", 0, 0.98),
    ("unlicense", "dedicate any and all copyright interest in the software to the public domain", 0, 0.96),
    ("wtfpl", "you just do what the fuck you want to", 0, 0.98),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed", 0, 0.96),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", 0, 0.97),
    ("postgresql", "postgresql database management system formerly known as postgres", 1, 0.9),
    ("hpnd", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted provided that the above copyright notice appears? in all copies", 1, 0.93),
    ("hpnd", "historical permission notice and disclaimer", 1, 0.95),
    ("curl", "copyright and permission notice copyright c .{0,60}? daniel stenberg", 0, 0.97),
    ("fair", "usage of the works is permitted provided that this instrument is retained with the works", 0, 0.98),
    ("beerware", "the beer ?ware license", 0, 0.95),
    ("beerware", "if we meet some day and you think this stuff is worth it you can buy me a beer", 0, 0.97),
    ("json", "the software shall be used for good not evil", 0, 0.98),
    ("ftl", "the freetype project license", 1, 0.95),
    ("ftl", "portions of this software are copyright .{0,40}? the freetype project", 0, 0.95),
    ("ijg", "this software is based in part on the work of the independent jpeg group", 0, 0.97),
    ("icu", "icu license icu 1 8 1 and later", 0, 0.97),
    ("unicode", "unicode inc license agreement data files and software", 0, 0.97),
    ("unicode", "unicode license v3", 1, 0.95),
    ("unicode", "permission is hereby granted free of charge to any person obtaining a copy of (?:the unicode )?data files", 0, 0.97),
    ("w3c", "w3c software (?:notice and|and document notice and) license", 1, 0.95),
    ("w3c", "by obtaining using and or copying this work you the licensee agree that you have read understood and will comply", 0, 0.95),
    ("upl-1", "the universal permissive license upl", 1, 0.95),
    ("blueoak-1", "blue oak model license", 1, 0.95),
    ("afl-3", "academic free license (?:version |v )?3(?: 0)?", 1, 0.95),
    ("afl", "licensed under the academic free license", 1, 0.9),
    ("naumen", "naumen public license", 1, 0.95),
    ("ecl-2", "educational community license (?:version )?2 0", 1, 0.95),
    ("mulan-psl-2", "mulan psl v2", 1, 0.95),
    ("mulan-psl-2", "mulan permissive software license version 2", 1, 0.97),
    ("mulan-psl-2", "you can use this software according to the terms and conditions of the mulan psl v2", 0, 0.98),
    # the Apache family
    ("apache-2", "apache license version 2 0 january 2004", 0, 0.99),
    ("apache-2", "licensed under the apache license version 2 0 the license", 0, 0.99),
    ("apache-2", "you may not use this file except in compliance with the license", 1, 0.9),
    ("apache-2", "you may obtain a copy of the license at (?:http|https) www apache org licenses license 2 0", 0, 0.98),
    ("apache-2", "www apache org licenses license 2 0", 1, 0.93),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", 1, 0.92),
    ("apache-2", "licensed to the apache software foundation asf under one or more contributor license agreements", 0, 0.97),
    ("apache-2", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license", 0, 0.96),
    ("apache-2", "terms and conditions for use reproduction and distribution 1 definitions", 0, 0.93),
    ("apache-1.1", "this product includes software developed by the apache software foundation", 0, 0.93),
    ("apache-1.1", "the apache software license version 1 1", 0, 0.97),
    ("apache-1", "this product includes software developed by the apache group for use in the apache http server project", 0, 0.97),
    # copyleft texts and notices
    ("gpl-2", "gnu general public license version 2 june 1991", 0, 0.99),
    ("gpl-2", "either version 2 of the license or at your option any later version", 1, 0.92),
    ("gpl-2", "gnu general public license version 2 as published by the free software foundation", 0, 0.96),
    ("gpl-2", "under the terms of version 2 of the gnu general public license", 0, 0.96),
    ("gpl-2", "you must cause the modified files to carry prominent notices stating that you changed the files and the date of any change", 0, 0.93),
    ("gpl-2", "51 franklin street fifth floor boston ma 02110 1301", 2, 0.8),
    ("gpl-2", "59 temple place suite 330 boston ma 02111 1307", 2, 0.8),
    ("gpl-3", "gnu general public license version 3 29 june 2007", 0, 0.99),
    ("gpl-3", "either version 3 of the license or at your option any later version", 1, 0.92),
    ("gpl-3", "under the terms of version 3 of the gnu general public license", 0, 0.96),
    ("gpl-3", "protecting users legal rights from anti circumvention law", 0, 0.96),
    ("gpl-3", "the gnu general public license is a free copyleft license for software and other kinds of works", 0, 0.97),
    ("gpl-1", "gnu general public license version 1 february 1989", 0, 0.99),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", 1, 0.93),
    ("gpl", "you should have received a copy of the gnu general public license along with", 1, 0.9),
    ("gpl", "this program comes with absolutely no warranty", 2, 0.7),
    ("gpl", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license", 1, 0.9),
    ("gpl", "the licenses for most software are designed to take away your freedom to share and change it", 0, 0.95),
    ("gpl-classpath", "linking this library statically or dynamically with other modules is making a combined work based on this library", 0, 0.96),
    ("gpl-classpath", "classpath exception", 2, 0.85),
    ("gpl-gcc-exception", "gcc runtime library exception", 1, 0.95),
    ("gpl-bison-exception", "you may create a larger work that contains part or all of the bison parser skeleton", 0, 0.97),
    ("gpl-openssl-exception", "in addition as a special exception .{0,120}? to link .{0,80}? with (?:the )?openssl", 1, 0.9),
    ("gpl-autoconf-exception", "the configuration script generated by autoconf", 2, 0.8),
    ("lgpl-2", "gnu library general public license version 2 june 1991", 0, 0.99),
    ("lgpl-2.1", "gnu lesser general public license version 2 1 february 1999", 0, 0.99),
    ("lgpl-2.1", "either version 2 1 of the license or at your option any later version", 1, 0.95),
    ("lgpl-3", "gnu lesser general public license version 3 29 june 2007", 0, 0.99),
    ("lgpl-3", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3", 0, 0.98),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", 1, 0.93),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public license along with", 1, 0.9),
    ("lgpl", "a program that contains no derivative of any portion of the library but is designed to work with the library", 0, 0.95),
    ("agpl-3", "gnu affero general public license version 3 19 november 2007", 0, 0.99),
    ("agpl-3", "specifically designed to ensure cooperation with the community in the case of network server software", 0, 0.97),
    ("agpl-3", "remote network interaction use with the gnu general public license", 0, 0.97),
    ("agpl", "you should have received a copy of the gnu affero general public license along with", 1, 0.93),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", 1, 0.95),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1", 0, 0.98),
    ("mpl-1.1", "alternatively the contents of this file may be used under the terms of either the gnu general public license", 1, 0.85),
    ("mpl-1", "the contents of this file are subject to the mozilla public license version 1 0", 0, 0.98),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", 0, 0.99),
    ("mpl-2", "if a copy of the mpl was not distributed with this file you can obtain one at", 0, 0.97),
    ("mpl-2", "mozilla org mpl 2 0", 1, 0.93),
    ("mpl-2", "this source code form is incompatible with secondary licenses", 0, 0.96),
    ("npl-1.1", "netscape public license version 1 1", 1, 0.95),
    ("epl-1", "the accompanying program is provided under the terms of this eclipse public license", 0, 0.93),
    ("epl-1", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", 0, 0.98),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0", 0, 0.98),
    ("epl-2", "eclipse org legal epl 2 0", 1, 0.93),
    ("epl-1", "eclipse org legal epl v10", 1, 0.93),
    ("edl-1", "eclipse distribution license v 1 0", 1, 0.95),
    ("cpl-1", "the accompanying program is provided under the terms of this common public license", 0, 0.97),
    ("ipl-1", "ibm public license version 1 0", 1, 0.95),
    ("cddl-1", "the contents of this file are subject to the terms of the common development and distribution license", 0, 0.97),
    ("cddl-1", "common development and distribution license cddl version 1 0", 0, 0.98),
    ("cddl-1.1", "common development and distribution license cddl version 1 1", 0, 0.98),
    ("osl-3", "licensed under the open software license version 3 0", 0, 0.97),
    ("eupl-1.2", "licensed under the eupl version 1 2", 0, 0.97),
    ("eupl-1.2", "european union public licen[cs]e v 1 2", 0, 0.97),
    ("eupl-1.1", "european union public licen[cs]e v 1 1", 0, 0.97),
    ("cecill-2.1", "cecill free software license agreement version 2 1", 0, 0.97),
    ("cecill", "governed by the cecill(?: [bc])? license under french law", 0, 0.96),
    ("cecill", "cecill", 5, 0.6),
    ("qpl-1", "the q public license version 1 0", 0, 0.97),
    ("sleepycat", "redistributions in any form must be accompanied by information on how to obtain complete source code", 0, 0.96),
    ("rpl-1.5", "reciprocal public license", 1, 0.9),
    ("cpal-1", "common public attribution license", 1, 0.95),
    ("ms-pl", "microsoft public license ms pl", 0, 0.97),
    ("ms-rl", "microsoft reciprocal license ms rl", 0, 0.97),
    ("artistic-1", "the artistic license preamble the intent of this document is to state the conditions under which a package may be copied", 0, 0.97),
    ("artistic-2", "artistic license 2 0 copyright c 2000 2006 the perl foundation", 0, 0.98),
    ("artistic-2", "this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed", 0, 0.96),
    ("perl", "this (?:program|library|module|package) is free software you can redistribute it and or modify it under the same terms as perl", 0, 0.96),
    ("python-2", "python software foundation license version 2", 0, 0.97),
    ("python-2", "psf hereby grants licensee a nonexclusive royalty free world wide license", 0, 0.97),
    ("php-3", "this source file is subject to version 3 0?1? ?of the php license", 0, 0.97),
    ("php-3", "products derived from this software may not be called php", 0, 0.97),
    ("zend-2", "this product includes the zend engine freely available at", 0, 0.96),
    ("ruby", "you may redistribute .{0,40}? under either the terms of the 2 clause bsdl", 0, 0.95),
    ("ruby", "ruby is copyrighted free software by yukihiro matsumoto", 0, 0.98),
    ("openssl", "this product includes software developed by the openssl project for use in the openssl toolkit", 0, 0.98),
    ("ssleay", "this product includes cryptographic software written by eric young", 0, 0.97),
    ("vim", "vim license", 1, 0.9),
    ("lppl-1.3", "this work may be distributed and or modified under the conditions of the latex project public license", 0, 0.97),
    ("lppl-1.3", "latex project public license", 1, 0.9),
    ("zpl-2", "zope public license", 1, 0.93),
    ("condor", "condor public license", 1, 0.93),
    ("intel", "intel open source license", 1, 0.93),
    ("apsl-2", "apple public source license", 1, 0.93),
    ("nasa-1.3", "nasa open source agreement", 1, 0.95),
    ("lucent-1.02", "lucent public license", 1, 0.95),
    ("sissl", "sun industry standards source license", 1, 0.95),
    ("spl-1", "sun public license", 1, 0.93),
    ("wxwindows", "wxwindows library licence", 1, 0.95),
    ("watcom", "sybase open watcom public license", 1, 0.95),
    ("entessa", "entessa public license", 1, 0.95),
    ("frameworx", "frameworx open license", 1, 0.95),
    ("motosoto", "motosoto open source license", 1, 0.95),
    ("multics", "multics license", 1, 0.85),
    ("nokia", "nokia open source license", 1, 0.95),
    ("ricoh", "ricoh source code public license", 1, 0.95),
    ("vovida", "vovida software license", 1, 0.95),
    ("sspl-1", "server side public license", 1, 0.95),
    ("busl-1.1", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work", 0, 0.98),
    ("busl-1.1", "change date .{0,40}? change license", 0, 0.9),
    ("elastic-2", "elastic license (?:v )?2(?: 0)?", 1, 0.95),
    ("elastic-2", "you may not provide the software to third parties as a hosted or managed service", 0, 0.97),
    ("commons-clause", "commons clause license condition", 0, 0.97),
    ("commons-clause", "the license does not grant to you the right to sell the software", 0, 0.96),
    ("polyform", "polyform (?:noncommercial|small business|shield|perimeter|strict) license", 1, 0.95),
    ("confluent", "confluent community license", 1, 0.95),
    ("timescale", "timescale license agreement", 1, 0.93),
    ("rsal", "redis source available license", 1, 0.95),
    ("hippocratic", "hippocratic license", 1, 0.95),
    # content, data, fonts and models
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain", 0, 0.98),
    ("cc0", "creative commons org publicdomain zero 1 0", 0, 0.97),
    ("cc0", "to the extent possible under law .{0,80}? has waived all copyright and related or neighboring rights", 0, 0.97),
    ("cc-pdm", "creative commons org publicdomain mark 1 0", 0, 0.96),
    ("cc-by", "creativecommons org licenses by [1234] 0", 1, 0.95),
    ("cc-by-sa", "creativecommons org licenses by sa [1234] [05]", 1, 0.95),
    ("cc-by-nd", "creativecommons org licenses by nd [1234] [05]", 1, 0.95),
    ("cc-by-nc", "creativecommons org licenses by nc [1234] [05]", 1, 0.95),
    ("cc-by-nc-sa", "creativecommons org licenses by nc sa [1234] [05]", 1, 0.95),
    ("cc-by-nc-nd", "creativecommons org licenses by nc nd [1234] [05]", 1, 0.95),
    ("cc0", "creativecommons org publicdomain zero 1 0", 0, 0.97),
    ("cc-by-4", "by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons attribution 4 0 international public license", 0, 0.98),
    ("cc-by-sa", "if you remix transform or build upon the material you must distribute your contributions under the same license as the original", 0, 0.95),
    ("cc-by-nc", "you may not use the material for commercial purposes", 0, 0.93),
    ("cc-by-nd", "if you remix transform or build upon the material you may not distribute the modified material", 0, 0.95),
    ("cc-by", "you must give appropriate credit provide a link to the license and indicate if changes were made", 2, 0.85),
    ("odbl-1", "open data commons open database license", 0, 0.97),
    ("odbl-1", "opendatacommons org licenses odbl", 1, 0.95),
    ("odc-by", "open data commons attribution license", 0, 0.97),
    ("odc-by", "opendatacommons org licenses by", 1, 0.93),
    ("pddl-1", "open data commons public domain dedication and licen[cs]e", 0, 0.97),
    ("cdla-permissive", "community data license agreement permissive", 0, 0.97),
    ("cdla-sharing", "community data license agreement sharing", 0, 0.97),
    ("ogl-uk-3", "open government licence v3 0", 0, 0.97),
    ("ogl-uk", "contains public sector information licensed under the open government licence", 0, 0.96),
    ("ogl-canada", "open government licence canada", 0, 0.96),
    ("etalab-2", "licence ouverte (?:version 2 0|etalab)", 0, 0.95),
    ("gfdl-1.3", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", 0, 0.97),
    ("gfdl-1.3", "with no invariant sections no front cover texts and no back cover texts", 1, 0.93),
    ("gfdl-1.2", "gnu free documentation license version 1 2 november 2002", 0, 0.98),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1", 0, 0.99),
    ("ofl-1.1", "scripts sil org ofl", 1, 0.93),
    ("ofl-1.1", "reserved font names? may not be used", 1, 0.85),
    ("bitstream-vera", "bitstream vera is a trademark of bitstream", 0, 0.96),
    ("ubuntu-font", "ubuntu font licen[cs]e", 1, 0.95),
    ("free-art-1.3", "(?:free art license|licence art libre)", 1, 0.93),
    ("openrail", "open(?: and)? responsible ai license", 1, 0.93),
    ("openrail", "use restrictions .{0,60}? you agree not to use the model or derivatives of the model", 0, 0.93),
    ("llama", "llama [234] community license agreement", 0, 0.97),
    ("gemma", "gemma terms of use", 1, 0.9),
    ("public-domain", "(?:dedicated to|released into|placed in|in) the public domain", 4, 0.7),
    ("public-domain", "this work is in the public domain", 1, 0.85),
    ("public-domain", "the author disclaims copyright to this source code", 0, 0.95),
    ("public-domain-us", "work of the (?:united states|u s) government .{0,60}? (?:public domain|not subject to copyright)", 1, 0.9),
    ("gutenberg", "project gutenberg license", 1, 0.93),
    ("gutenberg", "this ebook is for the use of anyone anywhere .{0,80}? at no cost and with almost no restrictions whatsoever", 0, 0.97),
    # badges, classifiers and metadata
    ("mit", "license osi approved mit license", 3, 0.95),
    ("apache-2", "license osi approved apache software license", 3, 0.9),
    ("bsd", "license osi approved bsd license", 3, 0.9),
    ("isc", "license osi approved isc license", 3, 0.95),
    ("gpl-2", "license osi approved gnu general public license v2", 3, 0.95),
    ("gpl-3", "license osi approved gnu general public license v3", 3, 0.95),
    ("gpl", "license osi approved gnu general public license gpl", 3, 0.9),
    ("lgpl-3", "license osi approved gnu lesser general public license v3", 3, 0.95),
    ("lgpl-2", "license osi approved gnu lesser general public license v2", 3, 0.95),
    ("lgpl", "license osi approved gnu library or lesser general public license", 3, 0.9),
    ("agpl-3", "license osi approved gnu affero general public license v3", 3, 0.95),
    ("mpl-2", "license osi approved mozilla public license 2 0", 3, 0.95),
    ("python-2", "license osi approved python software foundation license", 3, 0.95),
    ("zpl-2", "license osi approved zope public license", 3, 0.95),
    ("unlicense", "license osi approved the unlicense", 3, 0.95),
    ("cc0", "license cc0 1 0 universal", 3, 0.95),
    ("public-domain", "license public domain", 3, 0.85),
    ("proprietary", "license other proprietary license", 3, 0.9),
    ("mit", "img shields io badge license mit", 3, 0.93),
    ("apache-2", "img shields io badge license apache", 3, 0.93),
    ("bsd", "img shields io badge license bsd", 3, 0.9),
    ("gpl", "img shields io badge license gpl", 3, 0.9),
    ("agpl", "img shields io badge license agpl", 3, 0.9),
    ("mpl-2", "img shields io badge license mpl", 3, 0.9),
    ("mit", "opensource org licenses mit", 3, 0.95),
    ("apache-2", "opensource org licenses apache 2 0", 3, 0.95),
    ("bsd-3-clause", "opensource org licenses bsd 3 clause", 3, 0.95),
    ("bsd-2-clause", "opensource org licenses bsd 2 clause", 3, 0.95),
    ("isc", "opensource org licenses isc", 3, 0.95),
    ("gpl-3", "gnu org licenses gpl 3 0", 3, 0.93),
    ("gpl", "gnu org licenses gpl", 4, 0.85),
    ("lgpl", "gnu org licenses lgpl", 4, 0.85),
    ("agpl", "gnu org licenses agpl", 4, 0.85),
    ("gfdl", "gnu org licenses fdl", 4, 0.85),
    ("unlicense", "unlicense org", 3, 0.9),
    ("wtfpl", "wtfpl net", 3, 0.9),
    # proprietary terms
    ("proprietary", "proprietary and confidential", 5, 0.7),
    ("proprietary", "confidential and proprietary", 5, 0.7),
    ("proprietary", "all rights reserved", 6, 0.5),
    ("proprietary", "unauthori[sz]ed (?:copying|use|reproduction|distribution) of this (?:file|software|document|material)", 4, 0.8),
    ("proprietary", "no part of this (?:publication|document|book|work) may be reproduced", 4, 0.85),
    ("proprietary", "may not be copied reproduced or distributed without (?:the )?(?:express |prior )*(?:written )?(?:permission|consent)", 4, 0.8),
    ("proprietary", "this software is the confidential and proprietary information of", 1, 0.9),
    ("eula", "end user licen[cs]e agreement", 4, 0.8),
    ("eula", "by (?:installing|downloading|using|clicking) .{0,80}? you agree to be bound by (?:the terms of )?this (?:agreement|eula|licen[cs]e)", 4, 0.8),
    ("eula", "you may not reverse engineer decompile or disassemble", 4, 0.8),
    ("eula", "this software is licensed not sold", 4, 0.85),
    ("eula", "limited non exclusive non transferable (?:revocable )?licen[cs]e", 4, 0.75),
    ("evaluation", "for evaluation purposes only", 5, 0.6),
    ("non-commercial", "for (?:personal and )?non ?commercial use only", 4, 0.8),
    ("academic", "for (?:academic|research|educational)(?: and (?:academic|research|educational))? (?:use|purposes) only", 4, 0.8),
    ("trade-secret", "contains trade secrets", 5, 0.6),
    # bare names and hints
    ("gpl-unversioned", "(?:gnu general public license|gnu gpl)", 5, 0.6),
    ("lgpl-unversioned", "(?:gnu (?:lesser|library) general public license|gnu lgpl)", 5, 0.6),
    ("agpl-unversioned", "(?:gnu affero general public license|gnu agpl)", 5, 0.6),
    ("mpl-unversioned", "mozilla public license", 5, 0.6),
    ("epl-unversioned", "eclipse public license", 5, 0.6),
    ("apache-unversioned", "apache(?: software)? license", 5, 0.6),
    ("cc-unversioned", "creative commons(?: licen[cs]e)?", 6, 0.5),
    ("generic-license", "(?:see|refer to) (?:the )?licen[cs]e(?: file)? for (?:more )?(?:details|information)", 6, 0.4),
    ("generic-license", "see the (?:accompanying )?(?:license|licence|copying) file", 6, 0.4),
    ("generic-license", "licensed under the terms (?:found|described|specified) in", 6, 0.4),
    ("generic-license", "dual licensed under", 6, 0.5),
    ("warranty-disclaimer", "provided as is without warranty of any kind", 6, 0.4),
]
